"""Text helpers for table profiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shorten(text: Column, length: int = 300, suffix: str = "...") -> Column:
    """Text longer than ``length`` is cut, at a space where there is one, and gets the suffix."""
    if length <= 0:
        return text
    start = F.substring(text, 1, max(length - len(suffix), 0))
    return F.when(F.char_length(text) <= length, text).when(
        text.isNotNull(), F.concat(F.regexp_replace(start, "(?s) [^ ]*$", ""), F.lit(suffix))
    )
