"""Word helpers of the native operators; a word is a run of anything but space and tab to carriage return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
SPACES = "[ \\t-\\r]+"


def words(text: Column) -> Column:
    """The words of a text in order; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(F.length(trimmed) == 0, F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACES))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)
