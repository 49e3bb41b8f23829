"""Projection, tokenising and item explosion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodeworks.functions.text import split_literal, strip_ws


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Add many columns in one projection (a loop would nest one plan node each)."""
    return df.withColumns(dict(exprs))


def split_to_array(df: DataFrame, col: str, sep: str, out: str) -> DataFrame:
    return df.withColumn(out, split_literal(F.col(col), sep))


def explode_items(df: DataFrame, arr: str, out: str = "item", keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element, next to the ``keep`` columns.

    For a bare column Spark adds a "not empty" filter and pushes it below the
    projection, which then computes the array (a split, say) several times. An
    expression is left alone; null arrays give no rows either way.
    """
    return df.select(*keep, F.explode(F.coalesce(F.col(arr), F.array())).alias(out))


def lines_of(df: DataFrame, col: str, keep: Sequence[str] = (), out: str = "value") -> DataFrame:
    """Split multi-line text into one row per line, as a text file scan would."""
    # Plain replacements and a one-character split; a regular expression costs more.
    unix = F.replace(F.replace(F.col(col), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return df.select(*keep, F.explode(F.split(unix, "\n")).alias(out))


def tokenize(
    df: DataFrame,
    col: str = "value",
    keep: Sequence[str] = (),
    field_sep: str | None = None,
    token_sep: str = " ",
    strip: bool = True,
    drop_empty: bool = False,
    out: str = "token",
) -> DataFrame:
    """Tokens of a text column, optionally through fields (``field_sep``) first.

    Only the whole text is stripped, not the single fields. Empty tokens count
    as tokens unless ``drop_empty`` is set.
    """
    text = strip_ws(F.col(col)) if strip else F.col(col)
    if field_sep is None:
        tokens = df.select(*keep, F.explode(split_literal(text, token_sep)).alias(out))
    else:
        fields = df.select(*keep, F.explode(split_literal(text, field_sep)).alias("_field"))
        tokens = fields.select(*keep, F.explode(split_literal(F.col("_field"), token_sep)).alias(out))
    return tokens.where(F.col(out) != "") if drop_empty else tokens
