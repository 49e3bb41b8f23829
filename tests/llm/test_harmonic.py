"""Packing: pieces rebuild their documents, sequences have no gaps, padding is bounded."""

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from conftest import clashing
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodeworks.llm import harmonic
from lodeworks.llm.queries import op13_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@lru_cache
def library():
    return Tokenizer.from_file(PATH)


def encoded(text):
    return [*library().encode(text or "", add_special_tokens=False).ids, 0]


def check_layout(placed, capacity):
    """(sequence, offset, length) of all pieces: gapless from 0, within the capacity."""
    by = {}
    for sequence, offset, length in placed:
        by.setdefault(sequence, []).append((offset, length))
    for pieces in by.values():
        pieces.sort()
        assert [o for o, _ in pieces] == np.cumsum([0, *[n for _, n in pieces]])[:-1].tolist()
        assert sum(n for _, n in pieces) <= capacity
    return [sum(n for _, n in p) for p in by.values()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60), st.sampled_from([1, 2, 7, 64, 1000, 1024]), st.integers(1, 9))
def test_cut_and_bins(sizes, capacity, step):
    sizes = np.array(sizes, np.int64)
    bins, placed = harmonic.Bins(capacity, 5), []
    for first in range(0, len(sizes), step):
        some = sizes[first:first + step]
        doc, start, kinds = harmonic.cut(some, capacity)
        assert all(start[i] == bins.lengths[kinds[:i]][doc[:i] == doc[i]].sum() for i in range(0, len(doc), 7))
        placed.append(bins.add(kinds, np.stack([doc + first, start, bins.lengths[kinds]])))
    placed.append(bins.close().reshape(5, -1))
    doc, start, length, sequence, offset = np.concatenate(placed, axis=1).tolist()
    lengths = check_layout(zip(sequence, offset, length, strict=True), capacity)
    whole = {}
    for d, s, n in sorted(zip(doc, start, length, strict=True)):
        assert whole.get(d, 0) == s
        whole[d] = s + n
    assert whole == dict(enumerate(sizes.tolist()))
    if capacity & (capacity - 1) == 0:
        assert sum(n != capacity for n in lengths) <= 11 and all(n & (n - 1) == 0 for n in lengths)


@pytest.mark.parametrize("capacity", [16, 1000, 1024])
def test_pack_equals_the_library(docs, texts, capacity):
    rows = harmonic.pack(clashing(docs, ["start", "length", "sequence_id", "offset", "ids"]), PATH, capacity).collect()
    lengths = check_layout([(r.sequence_id, r.offset, r.length) for r in rows], capacity)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in rows)
    known = {i: encoded(t) for i, t in enumerate(texts) if i != 3}
    found = {}
    for r in sorted((r for r in rows if r.doc_id in known), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(found.setdefault(r.doc_id, [])) and r.doc_tokens == len(known[r.doc_id])
        found[r.doc_id] += r.ids
    assert found == known
    assert sum(r.length for r in rows if r.doc_id == 3) == 2 * len(encoded(texts[3]))  # the row comes twice
    assert sum(r.length for r in rows if r.doc_id is None) == len(encoded("a text without an id"))
    if capacity != 1000:
        assert all(n & (n - 1) == 0 for n in lengths)


def test_no_rows(empty):
    assert harmonic.pack(empty, PATH).isEmpty()
    with pytest.raises(ValueError):
        harmonic.pack(empty, PATH, 0)


def test_ids_of_any_type(spark):
    df = spark.createDataFrame([("a", "one two"), (None, None)], "key string, body string")
    rows = harmonic.pack(df, PATH, 4, id_col="key", text_col="body").collect()
    assert sorted((str(r.key), r.length) for r in rows) == [("None", 1), ("a", 1), ("a", 2)]


def test_query_is_whole_and_hardly_padded(spark, sf_dir):
    pieces = op13_packing(spark, sf_dir)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = pieces.orderBy("doc_id", "start").collect()
    found = {}
    for r in rows:
        assert r.start == found.get(r.doc_id, 0)
        found[r.doc_id] = r.start + r.length
    assert found == {d.doc_id: len(encoded(d.text)) for d in docs}
    first = next(d for d in docs if d.doc_id == rows[0].doc_id)
    assert rows[0].ids_crc32 == zlib.crc32(np.array(encoded(first.text)[:rows[0].length], "<u4").tobytes())
    check_layout([(r.sequence_id, r.offset, r.length) for r in rows], 1024)
    assert harmonic.sequences(pieces).agg(F.sum("padding")).first()[0] == 0
