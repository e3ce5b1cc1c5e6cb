"""Text normalisation and similarity columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# All characters that count as white space; none lies beyond the ideographic space.
SPACES = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def strip_all(column: Column | str) -> Column:
    """Leading and trailing white space removed, line breaks included."""
    return F.trim(column, F.lit(SPACES))


def normalised(column: Column | str) -> Column:
    """Lower case without surrounding white space."""
    return F.lower(strip_all(column))


def edit_similarity(column: Column | str, text: str) -> Column:
    """``1 - edits / longer length``, computed inside the JVM; null for a null text."""
    other = F.lit(text)
    longest = F.greatest(F.length(column), F.length(other))
    return F.when(F.length(column) + F.length(other) == 0, F.lit(1.0)).otherwise(
        F.lit(1.0) - F.levenshtein(column, other) / longest
    )
