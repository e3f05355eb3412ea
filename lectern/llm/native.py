"""Word arrays of whole texts as Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
_CHARS = " \t\n\x0b\f\r"


def words(text: Column | str) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none of a null or blank one."""
    inner = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(_CHARS))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE)).otherwise(F.array().cast("array<string>"))


def text_key(text: Column | str) -> Column:
    """Tells the texts of rows that repeat a key apart."""
    return F.xxhash64(text)
