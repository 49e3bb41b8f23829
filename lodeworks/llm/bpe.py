"""Exact BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a piece there is exactly one token that its encoding can end with.
An automaton over the vocabulary reports, at each end, all tokens that are a suffix of
the prefix; the one token is found by testing whether it can stand beside the last
token of the prefix it leaves. Two tokens can stand side by side if no merge across
their border comes before the merges that built them: undoing these merges, the latest
first, shows every pair that ever met at the border. Following the stored last
tokens back from the end emits the ids. No merge loop is run.

The work per piece is linear in its length. Ids of pieces are kept in a bounded memory
per Python worker for the length of a task. Defined results: null and empty texts have
no ids; strings of added tokens are these tokens; rows are treated one by one, equal
rows alike.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from lodeworks.llm.arrays import map_arrow, slices
from lodeworks.llm.pieces import Cutter, Memo, encode_texts, id_lists, tokenizer, vocabulary

PAIRS = 200_000  # answers of the pair test that a worker keeps
PIECES = 150_000  # pieces whose ids a worker keeps, twice


class PrefixEncoder:
    """Encodes pieces with one vocabulary file."""

    def __init__(self, path: str):
        words = vocabulary(path)
        self.added, merges, tokens = words["added"], words["merges"], words["tokens"]
        self.built = [-1] * len(tokens)  # the merge that builds a token; -1 for single bytes
        self.parts: list[tuple[int, int] | None] = [None] * len(tokens)
        self.merge = {}
        for rank, (left, right) in enumerate(merges):
            token = words["ids"][tokens[left] + tokens[right]]
            if self.parts[token] or (left, right) in self.merge:
                raise ValueError("a token with two merges has no unique last token per prefix")
            self.parts[token], self.built[token], self.merge[left, right] = (left, right), rank, rank
        self.beside: dict[tuple[int, int], bool] = {}
        self.reached = {}
        self.tokens = ahocorasick.Automaton()
        for token in [t for t in words["ids"].values() if len(tokens[t]) == 1] + [
                words["ids"][tokens[a] + tokens[b]] for a, b in merges]:
            if self._reachable(token):
                key = tokens[token].decode("latin-1")
                self.reached[tokens[token]] = token
                self.tokens.add_word(key, (token, len(key)))
        self.tokens.make_automaton()

    def _reachable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token. Parts are asked before what they build."""
        if self.parts[token] is None:
            return True
        left, right = self.parts[token]
        return self._stand(left, right, 2 * self.built[token])

    def _stand(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge across the border comes first.

        Ranks are doubled: among equal merges the one further left comes first, so a
        merge at the border precedes an equal one on its right but not one on its left.
        """
        built, parts, merge = self.built, self.parts, self.merge
        while True:
            rank = merge.get((left, right))
            if rank is not None and 2 * rank < limit:
                return False
            if built[left] < 0 and built[right] < 0:
                return True
            if built[left] > built[right]:
                limit, left = 2 * built[left], parts[left][1]
            else:
                limit, right = 2 * built[right] + 1, parts[right][0]

    def encode(self, piece: bytes) -> list[int]:
        if piece in self.added:
            return [self.added[piece]]
        token = self.reached.get(piece)
        if token is not None:
            return [token]
        beside = self.beside
        last: list[int | None] = [None] * (len(piece) + 1)
        size = [0] * (len(piece) + 1)
        for end, (token, length) in self.tokens.iter(piece.decode("latin-1")):
            if last[end + 1] is not None:
                continue
            start = end + 1 - length
            if start:
                before = last[start]
                if before is None:
                    continue
                fits = beside.get((before, token))
                if fits is None:
                    if len(beside) >= PAIRS:
                        beside.clear()
                    fits = beside[before, token] = self._stand(before, token, float("inf"))
                if not fits:
                    continue
            last[end + 1], size[end + 1] = token, length
        ids, at = [], len(piece)
        while at:
            ids.append(last[at])
            at -= size[at]
        return ids[::-1]

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        return [np.array(self.encode(p), "<u4").tobytes() for p in pieces]


@lru_cache(maxsize=1)
def _encoder(path: str) -> tuple[Cutter, Memo]:
    return Cutter(path), Memo(PrefixEncoder(path).encode_all, PIECES)


def _release() -> None:
    """Called at the end of a task: a worker that goes on to another stage keeps nothing of this one."""
    for kept in (_encoder, _token_bytes, vocabulary, tokenizer):
        kept.cache_clear()
    gc.collect()


@lru_cache(maxsize=1)
def _token_bytes(path: str) -> list[bytes]:
    return vocabulary(path)["tokens"]


def encode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, tokens`` of every row. The vocabulary file lies at the same path on every machine."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, memo = _encoder(vocabulary_path)
        for rows, data, offsets in slices(batches, "text"):
            ids, places = encode_texts(cutter, memo, data, offsets)
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(np.diff(places)), id_lists(ids, places)],
                                             names=["id", "n_tokens", "tokens"])
        _release()

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, n_tokens bigint, tokens array<int>").withColumnRenamed("id", id_col)


def decode_ids(ids: list[int], vocabulary_path: str) -> str:
    """The text of the ids; bytes that are no UTF-8 become replacement characters."""
    return b"".join(map(_token_bytes(vocabulary_path).__getitem__, ids)).decode("utf-8", "replace")


def decode(encoded: DataFrame, vocabulary_path: str, tokens_col: str = "tokens", text_col: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of its ids in ``text_col``; null ids give null."""
    schema = StructType([*encoded.schema.fields, StructField(text_col, StringType())])
    at = encoded.columns.index(tokens_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids.tolist(), vocabulary_path) for ids in (
                row.values.to_numpy() if row.is_valid else None for row in batch.column(at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, text_col])

    return map_arrow(encoded, run, schema)


def encode_and_decode(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, tokens, decoded`` of every row: both steps in one pass over the texts."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, memo = _encoder(vocabulary_path)
        for rows, data, offsets in slices(batches, "text"):
            ids, places = encode_texts(cutter, memo, data, offsets)
            texts = [decode_ids(ids[a:b].tolist(), vocabulary_path)
                     for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(np.diff(places)), id_lists(ids, places), pa.array(texts, pa.string())],
                names=["id", "n_tokens", "tokens", "decoded"])
        _release()

    kind = source.schema["id"].dataType.simpleString()
    return map_arrow(source, run, f"id {kind}, n_tokens bigint, tokens array<int>, decoded string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: texts encoded and decoded, without storing either."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = to_arrow_type(source.schema["id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, memo = _encoder(vocabulary_path)
        names = [str(i) for i in range(len(_token_bytes(vocabulary_path)))]
        for rows, data, offsets in slices(batches, "text"):
            ids, places = encode_texts(cutter, memo, data, offsets)
            of_ids, of_text = [], []
            for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                own = ids[a:b].tolist()
                of_ids.append(hashlib.sha256(",".join(map(names.__getitem__, own)).encode()).hexdigest())
                of_text.append(hashlib.sha256(decode_ids(own, vocabulary_path).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [rows.column("id").cast(kind), pa.array(np.diff(places)), pa.array(of_ids, pa.string()),
                 pa.array(of_text, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
        _release()

    named = f"id {source.schema['id'].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_arrow(source, run, named).withColumnRenamed("id", id_col)
