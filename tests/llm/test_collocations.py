"""Phrase collocations against a plain version; counting quotient filters against counters."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest import clashing, collected
from hypothesis import given, settings
from hypothesis import strategies as st

from lodeworks.llm import collocations, quotient


def plain(rows, max_words=5, min_count=100, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, max_words + 1):
                for p in range(len(words) - k + 1):
                    f[lang, *words[p:p + k]] += 1
    often = {g: a for g, a in f.items() if len(g) > 2 and a >= min_count}
    inside = set()
    for g, a in often.items():
        for m in range(2, len(g) - 1):
            for p in range(1, len(g) - m + 1):
                part = (g[0], *g[p:p + m])
                if 100 * a >= 100 * often[part]:
                    inside.add(part)
    out = {}
    for (lang, *words), a in often.items():
        if (lang, *words) in inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1))


def made(seed, n):
    rng = random.Random(seed)
    words = ["Lo", "lo", "mi", "É", "re", "ta", "ta-ta", "漢字", "x", "noch"]
    rows = []
    for _ in range(n):
        picked = []
        for _ in range(rng.randint(0, 25)):
            picked += rng.choice([[rng.choice(words)], ["in", "the", "year", "of", "our", "lord"], ["of", "the"]])
        glue = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " "]
        rows.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(w + rng.choice(glue) for w in picked)))
    return rows


SCHEMA = "lang string, text string"


@pytest.mark.parametrize(("shard", "segment"), [(200, 8), (16 << 20, 1 << 19)])
def test_equals_plain(spark, monkeypatch, shard, segment):
    monkeypatch.setattr(collocations, "SEGMENT", segment)
    monkeypatch.setattr(collocations, "LEAST_DIGIT", 3)
    rows = made(1, 400) + [("en", None), (None, ""), ("de", " \t"), (None, "lo lo lo lo lo lo " * 50)]
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(1 if shard > 200 else 7), ["id", "words", "shard", "n", "score"])
    found = sorted(collected(collocations.collocations(df, min_count=20)))
    assert found == plain(rows, min_count=20) and len({r[0] for r in found}) == 3


def test_top_and_fewer_words(spark):
    rows = made(2, 200)
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(collected(collocations.collocations(df, max_words=3, min_count=5, top=7))) == plain(rows, 3, 5, 7)
    with pytest.raises(ValueError):
        collocations.collocations(df, max_words=1)


def test_several_shards_in_a_task(spark):
    rows = made(3, 300) + [("en", " ".join(["a b c d e f"] * 1_500_000))]  # 18 MB: a shard of its own
    found = collected(collocations.collocations(spark.createDataFrame(rows, SCHEMA).coalesce(1)))
    by = {(r[0], r[2]): r for r in found}
    assert by["en", "a b c d e"][3] == 1_500_000 and by["en", "f a b c d"][3] == 1_499_999
    assert all(r in found for r in plain(rows[:300]) if r[0] == "und")


def test_repeated_rows_and_none(spark):
    df = spark.createDataFrame([("en", "one two three")] * 120, SCHEMA)
    assert collected(collocations.collocations(df)) == [("en", 1, "one two three", 120, 120, 120, 360, 3000)]
    assert collected(collocations.collocations(df.where("lang = 'x'"))) == []
    assert collected(collocations.collocations(df.limit(3))) == []


def test_scores_beyond_64_bits(spark):
    phrases = spark.createDataFrame([(10**13, 10**16, [3 * 10**13, 10**13], [2 * 10**13, 10**13], "x")],
                                    "a bigint, n bigint, heads array<bigint>, tails array<bigint>, lang string")
    row = collocations._scored(phrases, 2).first()
    assert (row.score, row.l, row.r) == (1000 * 10**13 * 10**16 // (3 * 10**13 * 2 * 10**13), 3 * 10**13, 2 * 10**13)


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 64), st.lists(st.tuples(st.integers(0, 2**64 - 1), st.sampled_from([1, 2, 254, 255, 256, 2**40])), max_size=300))
def test_filters_lose_nothing(bits, entries):
    counter = Counter()
    for number, times in entries:
        counter[number % (1 << bits)] += times
    numbers = np.array(sorted(counter), np.uint64)
    counts = np.array([counter[i] for i in sorted(counter)], np.int64)
    back, again = quotient.unpack(quotient.pack(numbers, counts, bits))
    assert back.tolist() == numbers.tolist() and again.tolist() == counts.tolist()
    if bits:
        mixed = quotient.mix(numbers, bits)
        assert quotient.unmix(mixed, bits).tolist() == numbers.tolist() and len(set(mixed.tolist())) == len(numbers)
        assert not len(mixed) or int(mixed.max()) < 1 << bits


def test_filters_merge():
    rng = np.random.default_rng(5)
    parts = [rng.integers(0, 50, n).astype(np.uint64) for n in (0, 1, 40, 200)]
    filters = [quotient.count(p) for p in parts]
    numbers, counts, places = quotient.merge(filters)
    assert dict(zip(numbers.tolist(), counts.tolist(), strict=True)) == Counter(np.concatenate(parts).tolist())
    assert (numbers[places] == np.concatenate([m for m, _ in filters])).all()
