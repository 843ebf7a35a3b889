"""Words as the operators count them, and rows that carry text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a word is a run of characters other than these separators.
SEPARATORS = r"\x20\x09-\x0D"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    squeezed = F.regexp_replace(text, rf"[^{SEPARATORS}]+", "w")
    return F.coalesce(F.length(F.regexp_replace(squeezed, rf"[{SEPARATORS}]+", "")), F.lit(0)).cast("bigint")


def utf8_bytes(text: Column) -> Column:
    """Length of a text in UTF-8; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")
