"""Columns shared by the native operators: ASCII lower case, words, places of a pattern."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word rule of the scans (digits, a-z and everything beyond ASCII).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z lower-cased and nothing else changed; null stays null."""
    plain = F.octet_length(text) == F.char_length(text)
    letters = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(plain, F.lower(text)).otherwise(letters)


def word_list(text: Column) -> Column:
    """The words of ``text`` after ASCII lower-casing; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_line(text: Column) -> Column:
    """The words of ``text``, lower-cased and joined by single spaces."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    return F.trim(F.regexp_replace(lowered, NO_WORD, " "))


def count_char(text: Column, char: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(char), F.lit("")))


def words_in(line: Column) -> Column:
    """How many words a line of single-spaced words has."""
    trimmed = F.trim(line)
    return F.when(trimmed == "", F.lit(0)).otherwise(count_char(trimmed, " ") + 1)


CHUNK = 256  # steps whose results are appended one by one


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def swept(n: Column, state: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """The ``n`` results of a sweep: ``step`` of a state and 0, 1, ... gives the next state and a result of type ``kind``.

    Appending to an array copies it, so results are appended to chunks of ``CHUNK``, and
    chunks to the list of chunks.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")

    def one(acc: Column, i: Column) -> Column:
        now, made = step(acc["state"], i)
        return F.struct(now.alias("state"), F.concat(acc["made"], F.array(made)).alias("made"))

    def chunk(acc: Column, c: Column) -> Column:
        places = F.sequence(c * CHUNK, F.least(n, (c + 1) * CHUNK) - 1)
        start = F.struct(F.element_at(acc, -1)["state"].alias("state"), none.alias("made"))
        return F.concat(acc, F.array(F.aggregate(places, start, one)))

    chunks = F.sequence(F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))
    every = F.aggregate(chunks, F.array(F.struct(state.alias("state"), none.alias("made"))), chunk,
                        lambda found: F.flatten(F.transform(found, lambda c: c["made"])))
    return F.when(n > 0, every).otherwise(none)
