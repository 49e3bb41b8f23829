"""SimHash, components, suffix deduplication and the whole pipeline against plain versions."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import collected
from lodeworks.llm import bpe, decontamination, nbsvm, queries, simhash, suffixes
from lodeworks.llm.components import components
from test_scans import plain_contamination

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text, n=3):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + n]) for i in range(max(1, len(found) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, bits=3):
    prints, parent = np.array(prints, np.uint64), list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, p in enumerate(prints):
        for j in np.flatnonzero(np.bitwise_count(prints ^ p) <= bits):
            parent[find(int(j))] = find(i)
    least = {}
    for i, own in enumerate(ids):
        if own is not None:
            least[find(i)] = min(own, least.get(find(i), own))
    return [least.get(find(i)) for i in range(len(ids))]


# --- components ----------------------------------------------------------------


def test_components_of_awkward_graphs(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(60)]  # a path
    edges += [(1000, 1000 + i) for i in range(200)] + [(5, 5), (70, 71), (71, 70)]  # a star, a loop, a pair twice
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(250)]
    got = dict(collected(components(spark.createDataFrame(edges, "u bigint, v bigint"))))
    nodes = sorted({n for e in edges for n in e})
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        parent[b] = a
    assert all(got.get(n, n) == find(n) for n in nodes)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


# --- SimHash -------------------------------------------------------------------


def test_any_linked_pair_shares_a_key():
    rng = random.Random(1)
    for bits in range(7):
        masks = simhash.key_masks(bits)
        assert len(masks) <= 12
        for _ in range(300):
            differ = sum(1 << b for b in rng.sample(range(64), bits))
            assert any((m & (2**64 - 1)) & differ == 0 for m in masks)


def test_near_duplicates(docs, texts, empty):
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    want = sorted(zip([r["doc_id"] for r in rows], prints, plain_components([r["doc_id"] for r in rows], prints), strict=True), key=str)
    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == want
    assert len({c for _, _, c in want}) < len(texts) - 5
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, _, c in want} | {None}
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0


@pytest.mark.parametrize("limit", [20_000, 4, 0])
def test_lists_of_any_length_link_the_same(spark, limit):
    """Near copies around a few centres: long posting lists, linked by search or by points."""
    rng = random.Random(9)
    centres = [rng.getrandbits(64) for _ in range(3)]
    prints = [c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(40)]
    prints += [rng.getrandbits(64) for _ in range(30)]
    prints = sorted(set(prints))
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    links = simhash.links(df, 3, limit)
    found = {n % 2**64: r % 2**64 for n, r in collected(components(links))}
    want = plain_components(prints, prints)
    groups, plain = {}, {}
    for p, w in zip(prints, want, strict=True):
        groups.setdefault(found.get(p, p), set()).add(p)
        plain.setdefault(w, set()).add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_a_list_of_copies_is_linked_by_a_forest():
    entries = np.array([sum(1 << b for b in pair) for pair in zip(range(0, 40), range(1, 41))], np.int64)
    links = simhash._spanning(entries, 3)
    assert len(links) == len(entries) - 1


def test_simhash_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    ids = [r["doc_id"] for r in rows]
    want = [(i, f"{p:016x}", c) for i, p, c in zip(ids, prints, plain_components(ids, prints), strict=True)]
    assert sorted(collected(queries.QUERIES["op6_simhash"](spark, sf_dir))) == sorted(want)


# --- suffix deduplication ------------------------------------------------------


def plain_cut(rows):
    first, out = {}, []
    for own, text in rows:
        data, key = (text or "").encode(), 2**63 - 1 if own is None else own
        for p in range(len(data) - 49):
            first[data[p:p + 50]] = min(first.get(data[p:p + 50], key), key)
    for own, text in rows:
        data, key = (text or "").encode(), 2**63 - 1 if own is None else own
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < key:
                gone[p:p + 50] = True
        spans = int((gone & ~np.append(False, gone[:-1])[:len(gone)]).sum())
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        out.append((own, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cut(df, **options):
    found = suffixes.deduplicate(df, **options)
    return sorted(collected(found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))), key=str)


def test_repeated_bytes(docs, empty):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert cut(docs) == plain_cut(rows)
    left = suffixes.remove_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    assert left.where("labels <> 'z' or slice <> 'z' or digit <> 'z'").count() == 0
    assert suffixes.deduplicate(empty).count() == 0


@pytest.mark.parametrize(("digits", "heavy"), [(2, 1 << 28), (64, 1 << 28), (64, 0), (16, 9000)])
def test_awkward_repeats(spark, monkeypatch, digits, heavy):
    monkeypatch.setattr(suffixes, "SLICE_BYTES", 3000)
    monkeypatch.setattr(suffixes, "STRETCH", 130)
    monkeypatch.setattr(suffixes, "SORTED_AT_ONCE", 100)
    rng = random.Random(3)
    base = "".join(rng.choice("abc é") for _ in range(400))
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) + base[rng.randint(0, 200):rng.randint(150, 400)] * rng.randint(
        0, 2) + rng.choice(["a" * 120, "ab" * 60, "", "漢字" * 30])) for i in range(60)]
    rows += [(None, base), (None, base), (70, None), (71, ""), (70, base), (70, base), (80, base[:49]), (81, base[:50])]
    assert cut(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), digits=digits, heavy_bytes=heavy) == plain_cut(rows)


def test_digits_grow_with_the_texts_and_2_gb_are_an_error(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(suffixes, "DIGIT_BYTES", 100)
    monkeypatch.setattr(suffixes, "_first_digit", lambda bits, make=suffixes._first_digit: seen.append(bits) or make(bits))
    rows = [(i, f"{i} " * 100) for i in range(100)]
    assert cut(spark.createDataFrame(rows, "doc_id bigint, text string")) == plain_cut(rows)
    assert seen == [(sum(len(t) for _, t in rows) // 100 - 1).bit_length()]
    with pytest.raises(OverflowError):
        suffixes.tiles(np.broadcast_to(np.uint8(0), 1 << 31), np.zeros(1, np.int64))


def test_groups_at_full_depth_are_the_repeated_windows():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1200] = data[3000:3200] = data[200:400]
    windows = np.arange(len(data) - 49)
    left, groups = suffixes.repeated_windows(data, windows)
    at = {}
    for w in windows:
        at.setdefault(data[w:w + 50].tobytes(), []).append(int(w))
    got = {}
    for w, g in zip(left, groups, strict=True):
        got.setdefault(g, []).append(int(w))
    assert sorted(map(sorted, got.values())) == sorted(v for v in at.values() if len(v) > 1)


def test_suffix_query(spark, sf_dir):
    rows = collected(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = sorted(collected(queries.QUERIES["op7_suffix_dedup"](spark, sf_dir)), key=str)
    assert found == plain_cut(rows) and sum(r[2] for r in found)


# --- pipeline ------------------------------------------------------------------


def test_each_stage_on_its_own_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    path = public_tokenizers.path("byte_bpe_50k.json")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination",
                     "BPE encoding and decoding"]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = corpus_pipeline.materialize(stage(spark, docs, sf_dir), "stage")
        after = {r["doc_id"]: r for r in out.collect()}
        assert out.count() == len(after) > 0
        if name.startswith("BPE"):
            assert len(after) == len(before) and all(after[r["doc_id"]]["decoded"] == (r["text"] or "") for r in before)
            assert all(bpe.decode_ids(r["tokens"], path) == r["decoded"] for r in after.values())
            break
        assert out.columns == columns
        if name.startswith("quality"):
            labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
            scores = dict(collected(nbsvm.score(docs, nbsvm.fit(docs, labels))))
            assert set(after) == {i for i, s in scores.items() if s >= 0.3}
        elif name.startswith("SimHash"):
            ids = [r["doc_id"] for r in before]
            assert set(after) == set(plain_components(ids, [plain_fingerprint(r["text"]) for r in before]))
        elif name.startswith("suffix"):
            want = {own: n for own, _, n, _, _ in plain_cut([(r["doc_id"], r["text"]) for r in before])}
            assert set(after) == set(want)
            for r in before:
                now = after[r["doc_id"]]
                assert now["n_chars"] == len(now["text"]) and (now["text"] == r["text"]) == (want[r["doc_id"]] == 0)
        else:
            items = collected(spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
            found = plain_contamination([(r["doc_id"], r["text"]) for r in before], items)
            assert set(after) == {own for own, n, hit, _ in found if not (hit and 20 * hit >= n)}
        docs = out


def test_stages_without_rows(spark, sf_dir):
    none = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_dir).count() == 0


def test_contamination_rule(spark):
    df = spark.createDataFrame([(1, 19, 1), (2, 20, 1), (3, 21, 1), (4, 0, 0)], "i int, n_words bigint, n_hit bigint")
    assert [r["i"] for r in df.where(decontamination.contaminated()).orderBy("i").collect()] == [1, 2]
