"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Unicode counts as white space, the set a
# whole-string strip removes (SQL trim alone would leave tabs).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_REGEX_SPECIAL = set("\\^$.|?*+()[]{}")


def strip_ws(col: Column) -> Column:
    """Drop all leading and trailing white space."""
    return F.btrim(col, F.lit(WHITESPACE))


def collapse_ws(col: Column) -> Column:
    """Turn every run of white space into one blank."""
    return F.regexp_replace(col, r"[\s\x1c-\x1f\x85\p{Z}]+", " ")


def split_literal(col: Column, sep: str) -> Column:
    """Split on the literal ``sep``, keeping empty parts."""
    if len(sep) == 1:
        # One plain or escaped character stays on Java's regex-free split path.
        pattern = "\\" + sep if sep in _REGEX_SPECIAL else sep
    else:
        pattern = "\\Q" + sep + "\\E"
    return F.split(col, pattern)
