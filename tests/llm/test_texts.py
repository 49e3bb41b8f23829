"""Quality rules, BPE, token files, HTML extraction and the classifier against plain versions."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import clashing, collected
from lodeworks.llm import bpe, lineblocks, nbsvm, pieces, queries, rules, simple8b
from lodeworks.llm.arrays import flat, slices
from lodeworks.sources.scratch import new_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def of_documents(spark, sf_dir):
    return dict(collected(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


# --- arrays --------------------------------------------------------------------


def test_slices_are_bounded_and_whole():
    texts = ["ab", None, "", "c" * 50, "é" * 3, "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "text"]).slice(1)
    got = list(slices([batch], "text", 10))
    assert [r.column("i").to_pylist() for r, _, _ in got] == [[1, 2], [3], [4, 5]]
    assert b"".join(bytes(d) for _, d, _ in got).decode() == "".join(t or "" for t in texts[1:])
    assert flat(pa.array([], pa.string()))[1].tolist() == [0]


# --- quality rules -------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    found = WORD.findall(text)
    seen, double = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            double += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(found) - 7):
        at[tuple(found[i:i + 8])].append(i)
    repeated = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), double, len(repeated)


MEASURED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_measures(docs, empty):
    book = rules.ledger(docs)
    got = collected(book.select("doc_id", *MEASURED))
    want = [(r["doc_id"], *plain_measures(r["text"])) for r in docs.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert rules.ledger(empty).count() == 0


def test_lines_and_windows_of_awkward_texts(spark):
    texts = ["a\nb\na", "a\n a\na \n\n\na", "\n" * 5, "w " * 8, "w " * 9, "a b c d e f g h " * 2, "\x0b\x0cx\x1cy\x0b", "x\r\nx\r\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert sorted(collected(rules.ledger(df).select("doc_id", *MEASURED))) == [(i, *plain_measures(t)) for i, t in enumerate(texts)]


def test_policies_and_ablations_read_the_ledger_alone(docs):
    book = rules.ledger(docs)
    table = [(r["failures"], r["kept"]) for r in rules.apply_policy(book, "v2").collect()]
    mask = rules.mask_of("v2")
    assert all(kept == (bits & mask == 0) for bits, kept in table)
    for r in rules.ablations(book, "v2").collect():
        bit = 1 << next(x.bit for x in rules.RULES if x.name == r["rule"])
        bits = [b & mask for b, _ in table]
        assert tuple(r)[1:] == (sum(b & bit > 0 for b in bits), sum(b == bit for b in bits), sum(b in (0, bit) for b in bits))
    assert [tuple(r)[1:] for r in rules.ablations(book.limit(0), "base").collect()] == [(0, 0, 0)] * 2


def test_rule_query(spark, sf_dir, of_documents):
    found = queries.QUERIES["op2_quality_rules"](spark, sf_dir).collect()
    assert len(found) == len(of_documents)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    for r in found:
        n, _, _, _, repeated = want = plain_measures(of_documents[r["doc_id"]])
        assert tuple(r)[1:6] == want and r["base_failed"] == (n < 20 or 100 * repeated > 30 * n)
        assert not (r["base_failed"] and r["kept"])
        if r["doc_id"] in labels and not r["base_failed"]:
            assert r["kept"] == bool(labels[r["doc_id"]])


# --- BPE -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def awkward(texts):
    rng = random.Random(5)
    alphabet = list("ab's tdmrevl'  \n\t.,!0123é漢👍 ́\x1c\x85ⅣⅧ") + ["Ᲊ", "<|endoftext|>", "'ll", "'re ", " '", "\r\n", "  ", "\x00", "<|endoftext|"]
    return texts + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + [
        "a" * 1000, "ab" * 700, "\n" * 77, "=" * 300, "a<|endoftext|> b<|endoftext|>", "'s", "''s", "x's'll"]


def test_ids_are_those_of_the_library(awkward):
    cutter, memo = bpe._encoder(PATH)
    ids, places = pieces.encode_texts(cutter, memo, *flat(pa.array(awkward)))
    library = pieces.tokenizer(PATH)
    for i, e in enumerate(library.encode_batch([t or "" for t in awkward], add_special_tokens=False)):
        own = ids[places[i]:places[i + 1]].tolist()
        assert own == e.ids, awkward[i]
        assert bpe.decode_ids(own, PATH) == library.decode(e.ids, skip_special_tokens=False) == (awkward[i] or "")


def test_any_ids_decode_as_in_the_library():
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(12)]
        assert bpe.decode_ids(ids, PATH) == pieces.tokenizer(PATH).decode(ids, skip_special_tokens=False)


def test_no_merge_beats_two_tokens_that_stand_together():
    coder = bpe.PrefixEncoder(PATH)
    rng = random.Random(2)
    tokens = [t for t in pieces.vocabulary(PATH)["tokens"] if t.isalpha() and len(t) < 6]
    for _ in range(2000):
        piece = rng.choice(tokens) + rng.choice(tokens)
        ids = coder.encode(piece)
        assert ids == list(np.frombuffer(pieces.library_ids(PATH)([piece])[0], "<u4"))
        assert all(coder._stand(a, b, float("inf")) for a, b in zip(ids, ids[1:]))


def test_bpe_columns(docs, empty):
    encoded = bpe.encode(docs, PATH)
    assert encoded.columns == ["doc_id", "n_tokens", "tokens"] and encoded.count() == docs.count()
    back = {(r["doc_id"], r["decoded"]) for r in bpe.decode(encoded, PATH).collect()}
    assert back == {(r["doc_id"], r["text"] or "") for r in docs.collect()}
    assert sorted(collected(bpe.encode_and_decode(docs, PATH)), key=str) == sorted(collected(bpe.decode(encoded, PATH)), key=str)
    for made in (bpe.encode, bpe.digests, bpe.encode_and_decode):
        assert made(empty, PATH).count() == 0


def test_memory_of_pieces_is_bounded(awkward):
    cutter, memo = pieces.Cutter(PATH), pieces.Memo(bpe.PrefixEncoder(PATH).encode_all, limit=50)
    data, offsets = flat(pa.array(awkward[12:60]))
    first = [pieces.encode_texts(cutter, memo, data, offsets)[0].tolist() for _ in range(3)]
    assert first[0] == first[1] == first[2]


def test_bpe_query(spark, sf_dir, of_documents):
    library = pieces.tokenizer(PATH)
    for r in queries.QUERIES["op4_bpe"](spark, sf_dir).collect():
        text = of_documents[r["doc_id"]]
        ids = library.encode(text, add_special_tokens=False).ids
        assert tuple(r)[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                hashlib.sha256(text.encode()).hexdigest())


# --- token files ---------------------------------------------------------------


def test_packing_round_trip():
    rng = np.random.default_rng(1)
    for k in range(120):
        n = int(rng.integers(0, 1500))
        ids = rng.integers(0, 50257, n).astype(np.uint64) if k % 2 else rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(
            0, 64, n).astype(np.uint64)
        if n > 5:
            ids[rng.integers(0, n, 3)] = 2**64 - 1  # beyond 60 bits: escapes
        packed = simple8b.pack(ids)
        assert (simple8b.unpack(packed) == ids).all()
        if n > 600:
            assert (simple8b.unpack(packed, 1, 2) == ids[256:768]).all()
    with pytest.raises(ValueError):
        simple8b.unpack(b"x" * 40)


def test_words_hold_as_many_ids_as_fit():
    assert len(simple8b.pack(np.zeros(240, np.uint64))) == simple8b.HEADER.size + 4 + 4 * 8
    assert len(simple8b.pack(np.full(256, 2**14))) == simple8b.HEADER.size + 4 + 64 * 8


def plain_token_rows(rows):
    library, start, out = pieces.tokenizer(PATH), 0, []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, docs, empty, monkeypatch):
    monkeypatch.setattr(simple8b, "SEGMENT", 2000)
    path = new_path(spark, "ids")
    simple8b.write(docs.where("doc_id is not null").dropDuplicates(["doc_id"]), path, PATH, files=4)
    got = sorted(collected(simple8b.read(spark, path, with_ids=False)))
    rows = sorted({(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None}, key=lambda r: r[0])
    assert got == plain_token_rows(rows)
    ids = {r["doc_id"]: r["ids"] for r in simple8b.read(spark, path).collect()}
    assert all(bpe.decode_ids(ids[i][:-1], PATH) == (t or "") and ids[i][-1] == 0 for i, t in rows)
    # A null id and a row that comes twice keep their own rows, without gaps.
    simple8b.write(docs, path + "-all", PATH, files=3)
    whole = sorted(collected(simple8b.read(spark, path + "-all", with_ids=False)), key=lambda r: r[1])
    assert len(whole) == docs.count() and whole[0][0] is None
    assert all(a[1] + a[2] == b[1] for a, b in zip(whole, whole[1:]))
    simple8b.write(empty, path + "-none", PATH, files=2)
    assert simple8b.read(spark, path + "-none").count() == 0


def test_token_file_query(spark, sf_dir, of_documents):
    assert sorted(collected(queries.QUERIES["op3_token_files"](spark, sf_dir))) == plain_token_rows(sorted(of_documents.items()))


# --- HTML ----------------------------------------------------------------------

LONG = "long text of an article " * 8


@pytest.mark.parametrize("html,text", [
    (None, ""), ("", ""), ("plain", "plain"), ("<p", ""), ("<!-- a --><p>x<!-- b", "x"),
    ("<p>Hello <b>world</b>!<p>Second &amp; &#x41;&nbsp;&eacute;<ul><li>One<li>Two</ul>", "Hello world!\n\nSecond & A é\n\nOne\n\nTwo"),
    (f"<div id=comments><p>{LONG}</div><div><p>{LONG}</p><p>End.</div><div class='side sidebar'>{LONG}</div>", LONG.strip() + "\n\nEnd."),
    (f"<header>{LONG}</header><article><header><h1>T</h1></header><p>x<div class='ad'>{LONG}</div></article><p>{LONG}", "T\n\nx"),
    ("a<script>var x = '<p>';</script>b<style>p{}</style>", "ab"),
    (f"<nav><p>m</p></nav><ul><li><a href=x>{LONG}</a></ul><p>{LONG}", LONG.strip()),
    (f"<form><p>{LONG}</form><main><p>In</main><div class=cookie-notice>{LONG}</div><footer>{LONG}", "In"),
    ("<article><p>a<br>b   c\n d<p>Q&am</article>", "a b c d\n\nQ&am"),
    (f"<div role='navigation'>{LONG}</div><table><tr><td>{LONG}<td>1<tr><td>2</table>", f"{LONG.strip()}\n\n1\n\n2"),
])
def test_main_text(html, text):
    assert lineblocks.main_text(html) == text


def test_surge_and_dive_without_marks():
    page = f"<div>Home</div><div>About</div><div>x</div><div><p>{LONG}<p>Yes.<p>{LONG}<p>Last.</div><div>1</div><div>2</div><div>3</div>"
    assert lineblocks.main_text(page) == "\n\n".join([LONG.strip(), "Yes.", LONG.strip(), "Last."])


def test_pages_query(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r["page_id"]: r for r in queries.QUERIES["op10_html_extraction"](spark, sf_dir).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", article))
        clean = [re.sub(r"\s+", " ", __import__("html").unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in blocks]
        want = "\n\n".join(b for b in clean if b)
        assert tuple(found[r["page_id"]]) == (r["page_id"], r["url"], want, len(want))
    odd = clashing(pages.limit(5), ["id", "address", "text", "n_chars"])
    assert lineblocks.extract(odd).columns == ["page_id", "url", "text", "n_chars"] and lineblocks.extract(odd.limit(0)).count() == 0


@pytest.mark.parametrize("html,text", [
    # Teaser cards are marked, the article is not; and a card beside a marked article.
    (f"<div><p>{LONG}<p>End.</div><article><p>Card one</article><article><p>Card two</article>", f"{LONG.strip()}\n\nEnd."),
    (f"<article><h1>T</h1><div><p>{LONG}</div><p>End.</article><p>Off<article><p>Card</article>", f"T\n\n{LONG.strip()}\n\nEnd."),
    # A main part that wraps a listing, a card and the article.
    (f"<main><ul><li><a href=x>{LONG}</a></ul><article><p>Card</article><h1>T</h1><article><p>{LONG}<p>End.</article><p>Last</main>",
     f"T\n\n{LONG.strip()}\n\nEnd.\n\nLast"),
    (f"<article><div>Start.</div><p>{LONG}<div>x</div><div>y</div><div>z</div></article>", f"Start.\n\n{LONG.strip()}\n\nx\n\ny\n\nz"),
])
def test_surge_and_dive_with_marks(html, text):
    assert lineblocks.main_text(html) == text


INSIDE = ["<p class='social-history'>a</p>", "<section id='related-work'><p>a</section>", "<p>a <span class='share-price'>b</span> c</p>",
          "<div class='ad-hoc'>a</div>", "<div id='search-methods'>a</div>", "<p>a <b class=alert>b</b> <span aria-hidden=true>c</span></p>",
          "<div class='page-header'>a</div>", "<section id=consent>a</section>", "<p><math><mi>x</mi><mo>=</mo><mn>1</mn></math></p>",
          "<p>a <noscript>b</noscript></p>", f"<p><a href=x>{LONG}</a></p>"]
WANT = ["a", "a", "a b c", "a", "a", "a b c", "a", "a", "x=1", "a b", LONG.strip()]


@pytest.mark.parametrize("part,want", list(zip(INSIDE, WANT, strict=True)))
def test_article_text_is_whole(part, want):
    whole = "\n\n".join([LONG.strip(), want, LONG.strip()])
    assert lineblocks.main_text(f"<nav>x</nav><article><p>{LONG}</p>{part}<p>{LONG}</article>") == whole
    if not re.search("page-header|consent", part):
        assert lineblocks.main_text(f"<nav>x</nav><div><p>{LONG}</p>{part}<p>{LONG}</div>") == whole


@pytest.mark.parametrize("name", ["ad", "x ad-slot", "ads2", "left-sidebar", "cookie-banner", "cookie_notice", "comments-section", "main-nav",
                                  "site-footer", "Breadcrumbs", "notice", "reader-comments"])
def test_what_is_never_article(name):
    for attribute in ("class", "id"):
        assert lineblocks.main_text(f"<article><p>{LONG}<div {attribute}='{name}'>{LONG}</div></article>") == LONG.strip()


def test_annotations_of_formulas_are_not_text():
    page = "<article><p>Let <math><semantics><mi>x</mi><annotation encoding=tex>x</annotation></semantics></math>.</article>"
    assert lineblocks.main_text(page) == "Let x."


@pytest.mark.parametrize("other", ["", "<div>", "<section>"])
def test_pages_without_their_marks(spark, sf_dir, other):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    bare = pages.withColumn("html", F.replace(F.replace("html", F.lit("<article>"), F.lit(other)),
                                              F.lit("</article>"), F.lit(other.replace("<", "</"))))
    assert bare.where("html like '%article>%'").count() == 0
    assert sorted(collected(lineblocks.extract(bare))) == sorted(collected(lineblocks.extract(pages)))


# --- classifier ----------------------------------------------------------------


def plain_vectors(text):
    return sorted(set(zip(*[x.tolist() for x in nbsvm.features(*flat(pa.array([text], pa.string())))])))


def test_features_do_not_depend_on_the_slice(texts):
    rows, found = nbsvm.features(*flat(pa.array(texts)))
    for i, text in enumerate(texts):
        assert sorted(found[rows == i].tolist()) == sorted(f for _, f in plain_vectors(text))


def test_descent_solves_the_dual():
    rng = np.random.default_rng(3)
    points = rng.normal(size=(60, 5))
    signs = np.where(points @ np.array([2, -1, 0.5, 0, 0]) + 0.2 * rng.normal(size=60) > 0, 1.0, -1.0)
    at = np.arange(5)
    weights, bias = nbsvm.descend([(at, p) for p in points], signs, 5, rounds=2000)

    def loss(w, b):
        return 0.5 * (w @ w + b * b) + np.maximum(0, 1 - signs * (points @ w + b)).sum()

    best = loss(weights, bias)
    for _ in range(300):
        assert loss(weights + 0.05 * rng.normal(size=5), bias + 0.05 * rng.normal()) >= best - 1e-3


def test_log_ratios():
    counts, totals = np.array([[0, 4, 1], [9, 4, 0]]), np.array([4, 9])
    got = nbsvm.log_ratios(counts, totals)
    assert np.allclose(got, np.log((counts[1] + 1) / 11 / ((counts[0] + 1) / 6)))


def test_classifier_on_odd_rows(spark, docs, empty):
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(11, 45)] + [(12, None), (13, 1), (999, 0)], "doc_id bigint, quality int")
    model = nbsvm.fit(docs, clashing(labels, ["text", "class", "id"]))
    scored = collected(nbsvm.score(docs, model))
    assert len(scored) == docs.count() and all(0 <= s <= 1 for _, s in scored)
    kept = nbsvm.keep_accepted(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s >= 0.3 for _, s in scored)
    assert nbsvm.score(empty, model).count() == nbsvm.keep_accepted(empty, model).count() == 0
    for some, share in ((labels.limit(0), 0.5), (labels.where("quality = 1"), 1.0)):
        lone = nbsvm.fit(docs, some)
        assert {round(s, 3) for _, s in collected(nbsvm.score(docs.limit(3), lone))} == {share}
    assert {round(s, 3) for _, s in collected(nbsvm.score(docs.limit(3), nbsvm.fit(empty, labels)))} == {0.5}


def test_held_out_rows_are_not_learned_from(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.withColumn("quality", F.when(nbsvm.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = nbsvm.fit(docs, labels), nbsvm.fit(docs, wrong)
    assert (one.weights == two.weights).all() and (one.slope, one.shift) == (two.slope, two.shift)


def test_classifier_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.QUERIES["op9_quality_classifier"](spark, sf_dir)
    joined = found.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for r in joined:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.3)
    unseen = [r for r in joined if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in unseen) >= 0.97 * len(unseen)


def test_shuffled_labels_give_the_same_scores(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    few, many = (sorted(collected(nbsvm.score(docs, nbsvm.fit(docs, labels, broadcast_bytes=b))), key=str) for b in (1 << 20, 0))
    assert [r[0] for r in few] == [r[0] for r in many] and np.allclose([r[1] for r in few], [r[1] for r in many])


@pytest.mark.parametrize(("page", "n"), [
    ("<b>" * 100_000 + f"<p>{LONG}</p>" * 3, 3), ("<article>" + "<i>" * 100_000 + f"<p>{LONG}</u></p>" * 2_000, 2_000),
    ("<div>" * 50_000 + f"<p>{LONG}" * 50_000, 50_000), ("<ul><li>" * 20_000 + f"<li>{LONG}" * 100, 100),
])
def test_very_many_open_elements_take_linear_time(page, n):
    start = time.perf_counter()
    assert lineblocks.main_text(page).count(LONG.strip()) == n
    assert time.perf_counter() - start < 30


def test_stored_ledger_gives_policies_and_ablations(docs):
    book = rules.store(docs)
    assert "Scan parquet" in book._jdf.queryExecution().executedPlan().toString()
    assert sorted(collected(book), key=str) == sorted(collected(rules.ledger(docs)), key=str)
    assert sorted(collected(rules.ablations(book, "v2"))) == sorted(collected(rules.ablations(rules.ledger(docs), "v2")))
