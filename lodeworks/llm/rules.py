"""Quality rules as a bitmask ledger.

``ledger`` looks at every text once and stores its measurements and one failure bit per
rule. A policy is a versioned set of bits: ``apply_policy`` and ``ablations`` read the
ledger alone. Ablations count rows per failure mask first (at most 2^rules rows), so
trying a policy moves no documents.

Defined results: null and empty texts have no words and fail ``few_words``; equal rows
give equal rows, one each; no rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from lodeworks.llm.arrays import BLANK, codes_of, gather, map_arrow, per_row, slices, tiles, word_bounds
from lodeworks.sources.scratch import materialize

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_adjacent", "n_upper",
            "n_letters", "n_digits")

# Fixed values of the contract.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
INNER = np.zeros(256, bool)  # bytes that continue a code point
INNER[0x80:0xC0] = True
UPPER = np.zeros(256, bool)
UPPER[0x41:0x5B] = True
LETTER = UPPER.copy()
LETTER[0x61:0x7B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    values, places = gather(data, starts, ends)
    return codes_of(tiles(values, places[:-1]))


def _joined(codes: np.ndarray, gap: int) -> np.ndarray:
    """Codes of the pairs of sequences that start ``gap`` apart."""
    if len(codes) <= gap:
        return codes[:0]
    return codes_of(pa.array(codes[:-gap] * (codes.max() + 1) + codes[gap:]))


def _repeated(codes: np.ndarray, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Per row: words inside windows that occur twice or more in the row."""
    grams = _joined(_joined(_joined(codes, 1), 2), 4)
    n = len(grams)
    if n == 0:
        return np.zeros(len(places) - 1, np.int64)
    whole = rows[:n] == rows[WINDOW - 1:]
    often = np.bincount(grams[whole], minlength=grams.max() + 1)
    at = np.flatnonzero(whole & (often[grams] > 1))
    _, inverse, counts = np.unique(grams[at] * (rows[-1] + 1) + rows[at], return_inverse=True, return_counts=True)
    at = at[counts[inverse] > 1]
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + WINDOW, -1)
    return per_row(np.cumsum(change[:-1]) > 0, places)


def _double_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: lines with a word, and those of them equal to an earlier line of the row."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 0x0A)
    edges = np.unique(np.concatenate([breaks, breaks + 1, offsets]))
    starts, ends = edges[:-1], edges[1:]
    solid = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~BLANK[data], out=solid[1:])
    keep = solid[ends] > solid[starts]
    starts, ends = starts[keep], ends[keep]
    rows = np.searchsorted(offsets, starts, "right") - 1
    lines = _words(data, starts, ends)
    _, first = np.unique(lines * n + rows, return_index=True)
    n_lines = np.bincount(rows, minlength=n)
    return n_lines, n_lines - np.bincount(rows[first], minlength=n)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    if not len(data):
        return {name: np.zeros(n, np.int64) for name in MEASURES}
    starts, ends, places = word_bounds(data, offsets)
    codes = _words(data, starts, ends)
    rows = np.repeat(np.arange(n), np.diff(places))
    n_lines, n_dup_lines = _double_lines(data, offsets)
    again = np.zeros(len(codes), bool)
    again[1:] = (codes[1:] == codes[:-1]) & (rows[1:] == rows[:-1])
    return {
        "n_words": np.diff(places), "word_chars": per_row(~BLANK[data] & ~INNER[data], offsets),
        "n_symbols": per_row(SYMBOLS[data], offsets), "n_dup_lines": n_dup_lines,
        "n_repeat_words": _repeated(codes, rows, places), "n_lines": n_lines, "n_adjacent": per_row(again, places),
        "n_upper": per_row(UPPER[data], offsets), "n_letters": per_row(LETTER[data], offsets),
        "n_digits": per_row(DIGIT[data], offsets),
    }


@dataclass(frozen=True)
class Rule:
    """``fails`` is a condition on the measurements; the bit never changes its meaning."""

    name: str
    bit: int
    fails: Callable[[], Column]


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 20),
    Rule("repeated_windows", 1, lambda: F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
    Rule("symbols", 2, lambda: F.col("n_symbols") * 10 > F.col("n_words")),
    Rule("capitals", 3, lambda: (F.col("n_letters") >= 20) & (F.col("n_upper") * 2 > F.col("n_letters"))),
    Rule("stutter", 4, lambda: F.col("n_adjacent") * 5 > F.col("n_words")),
    Rule("doubled_lines", 5, lambda: (F.col("n_lines") >= 3) & (F.col("n_dup_lines") * 2 > F.col("n_lines"))),
    Rule("word_length", 6, lambda: (F.col("word_chars") < F.col("n_words") * 2) | (
        F.col("word_chars") > F.col("n_words") * 20)),
    Rule("digits", 7, lambda: F.col("n_digits") * 2 > F.col("word_chars")),
)
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "capitals", "stutter", "word_length", "digits"),
    "v2": tuple(rule.name for rule in RULES),
}


def mask_of(policy: str) -> int:
    return sum(1 << rule.bit for rule in RULES if rule.name in POLICIES[policy])


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = StructType([StructField("id", source.schema["id"].dataType)] + [StructField(m, LongType()) for m in MEASURES])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, "text"):
            found = measure(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id").cast(arrow.field("id").type), *(pa.array(found[m], pa.int64()) for m in MEASURES)],
                schema=arrow)

    return map_arrow(source, run, out).withColumnRenamed("id", id_col)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements of every row and ``failures``, one bit per rule."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measurements(docs, id_col, text_col).withColumn("failures", bits)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a stored table: texts are read once, whatever policies and ablations follow."""
    return materialize(ledger(docs, id_col, text_col), "ledger")


def passes(policy: str) -> Column:
    """True if no rule of the policy failed."""
    return F.col("failures").bitwiseAND(F.lit(mask_of(policy)).cast("long")) == 0


def apply_policy(book: DataFrame, policy: str) -> DataFrame:
    return book.withColumn("kept", passes(policy))


def ablations(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: rows that fail it, that fail it alone, and that are kept without it."""
    mask = mask_of(policy)
    masks = book.groupBy(F.col("failures").bitwiseAND(F.lit(mask).cast("long")).alias("fails")).agg(
        F.count("*").alias("n"))
    counted = []
    for rule in RULES:
        if rule.name in POLICIES[policy]:
            bit = F.lit(1 << rule.bit).cast("long")
            has, alone = F.col("fails").bitwiseAND(bit) != 0, F.col("fails") == bit
            kept = alone | (F.col("fails") == 0)
            counted += [F.struct(F.lit(rule.name).alias("rule"), *[
                F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias(name)
                for name, cond in (("n_fail", has), ("n_fail_alone", alone), ("n_kept_without", kept))])]
    return masks.agg(F.array(*counted).alias("rules")).select(F.inline("rules"))

