"""Joins to dated or coded tables: rates, catalogue, branches, accounts.

No side is marked for broadcast: sizes in bytes, known from files or measured by
adaptive execution, decide against the session's threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def convert_currency(
    movements: DataFrame,
    rates: DataFrame,
    currency: str,
    business_date: str,
    trim_currency: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Adds ``exchange_rate``: the rate of the row's currency on its business date.

    A movement without a rate is dropped, whatever its currency; ``how="left_anti"``
    gives exactly those dropped rows instead.
    """
    lookup = rates.select(
        F.col("currency_id").alias("rate_currency"),
        F.col("load_date").alias("rate_date"),
        F.col("exchange_currency_min_amount").alias("exchange_rate"),
    )
    code = F.trim(currency) if trim_currency else F.col(currency)
    joined = movements.join(
        lookup,
        (code == F.col("rate_currency")) & (F.col(business_date) == F.col("rate_date")),
        how,
    )
    return joined if how == "left_anti" else joined.drop("rate_currency", "rate_date")


def with_concept(
    rows: DataFrame,
    catalogue: DataFrame,
    key: str,
    *columns: str | Column,
) -> DataFrame:
    """Catalogue columns of the concept whose key equals ``key``; unmatched rows drop."""
    wanted = columns or (
        "data_code_id",
        "sender_application_id",
        "commercial_product_type",
        "commercial_subproduct_type",
    )
    lookup = catalogue.select(F.col("primary_key_type").alias("catalogue_key"), *wanted)
    return rows.join(lookup, F.col(key) == F.col("catalogue_key"), "inner").drop("catalogue_key")


def join_filtered(
    left: DataFrame,
    right: DataFrame,
    pairs: dict[str, str],
    right_filter: str | None = None,
    select: list[str] | None = None,
    how: str = "inner",
) -> DataFrame:
    """Declared join: column pairs ``{left: right}``, the right side filtered first.

    Only left-hand columns come out (``select``, or all of them).
    """
    other = right.where(F.expr(right_filter)) if right_filter else right
    other = other.select(*[F.col(r).alias(f"_right_{r}") for r in dict.fromkeys(pairs.values())])
    condition = [F.col(s) == F.col(f"_right_{o}") for s, o in pairs.items()]
    joined = left.join(other, condition, how)
    return joined.select(*(select or left.columns))
