"""Keys, signs and amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(17,2)"


def money(column: Column | str) -> Column:
    """Amount rounded half-up to the layout's two decimals."""
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def joined_key(*parts: Column | str) -> Column:
    """Parts glued together; null as soon as one part is null."""
    return F.concat(*parts)


def whole_number(column: Column | str) -> Column:
    """Text as an integer, decimals cut off; null when it is no number or too large."""
    text = F.col(column) if isinstance(column, str) else column
    return text.try_cast("double").try_cast("int")


def padded_account(column: Column | str, width: int = 10) -> Column:
    """Account number left-padded with zeros to ``width``.

    Text already ``width`` long is used as it is.  Anything else is read as a
    number; text that is not one gives null, so that it joins to nothing.
    """
    text = F.col(column) if isinstance(column, str) else column
    number = whole_number(text)
    padded = F.when(number.isNotNull(), F.format_string(f"%0{width}d", number))
    return F.when(F.length(text) == width, text).otherwise(padded)


def two_digit(column: Column | str) -> Column:
    """Two-character codes unchanged, all others prefixed by one zero."""
    text = F.col(column) if isinstance(column, str) else column
    return F.when(F.length(text) == 2, text).otherwise(F.concat(F.lit("0"), text))


def flipped_unless(keep: Column, amount: Column | str) -> Column:
    """Amount kept where ``keep`` is true, negated where it is false or null."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return F.when(keep, value).otherwise(-value)


def flipped_if(flip: Column, amount: Column | str) -> Column:
    """Amount negated where ``flip`` is true, kept where it is false or null."""
    value = F.col(amount) if isinstance(amount, str) else amount
    return F.when(flip, -value).otherwise(value)


def currency_from_code(column: Column | str) -> Column:
    """Dollar for contract currency codes strictly inside 19-29 and 69-79, else peso.

    The code is text; text that is not a number counts as peso.
    """
    code = whole_number(column)
    dollar = ((code > 19) & (code < 29)) | ((code > 69) & (code < 79))
    return F.when(dollar, F.lit("USD")).otherwise(F.lit("MXP"))
