"""Missing-value conventions shared by every operator.

Inside the library a missing field is SQL NULL.  The sentinel text only
appears at sinks (``fill_sentinel``) and is recognised on input
(``is_present``) so that records read back from CSV behave the same.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text that stands for "missing" in records and reports.
SENTINEL = "Not explicitly mentioned"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_present(col: Column | str) -> Column:
    """True when the value is non-NULL, non-empty and not the sentinel."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit("")) & (c != F.lit(SENTINEL))


def null_if_missing(col: Column | str) -> Column:
    """NULL for empty strings and the sentinel, the value otherwise."""
    c = _c(col)
    return F.when(is_present(c), c)


def sentinel_or(col: Column | str) -> Column:
    """The value as text, or the sentinel when it is missing."""
    c = _c(col).cast("string")
    return F.when(is_present(c), c).otherwise(F.lit(SENTINEL))


def fill_sentinel(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace missing values of ``cols`` by the sentinel (sink-side view)."""
    cols = list(cols)
    return df.withColumns({c: sentinel_or(c) for c in cols})


def strip_chars(col: Column | str, chars: str) -> Column:
    """Remove any of ``chars`` from both ends (Python ``str.strip(chars)``)."""
    return F.btrim(_c(col), F.lit(chars))


# Python's str.strip() default set, restricted to the characters that occur
# in text: space, tab, newline, carriage return, vertical tab, form feed.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(col: Column | str) -> Column:
    return strip_chars(col, WHITESPACE)
