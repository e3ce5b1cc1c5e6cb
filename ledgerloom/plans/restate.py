"""Restating a month from late rows alone.

Detail sums add up: those of the rows that arrived up to a day, and those of the rows that arrived later, are together the sums of
all rows.  Each delivery's sums are kept as one partition of a table, named by its arrival bound.  A delivery reads only its own
movements; facts are rolled up from the kept sums, however many movements are behind them.

Accounts and catalogue are taken as they are when facts are rolled up.  Rates are applied to each movement when it is
summed: a rate that is corrected later restates nothing until its deliveries are summed again.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.operators.concepts import (
    ConceptFamily,
    amount_and_count_rows,
    detail_sums,
    keep_open_accounts,
    known_concepts,
    roll_up,
)
from ledgerloom.operators.snapshots import open_account_copies
from ledgerloom.plans import families
from ledgerloom.sinks.tables import replace_partition
from ledgerloom.sources import movements as read
from ledgerloom.sources.files import read_zone

#: Columns that tell apart what is summed.
KEYS = ("family", "account_id", "account_key", "concept_key")
#: Tables whose movements carry an arrival date, and so can be late.
LATE_TABLES = ("transfers", "collections", "cheques", "deposits")


def arrived_after(tables: Mapping[str, DataFrame], after: str | None) -> dict[str, DataFrame]:
    """The tables with only those movements that arrived after a day (all without one)."""
    if after is None:
        return dict(tables)
    late = {n: t.where(F.col("load_date") > as_date(after)) for n, t in tables.items() if n in LATE_TABLES}
    return {**tables, **late}


def late_sources(tables: Mapping[str, DataFrame], odate: str, datem: str) -> list[families.Source]:
    """Valued movements of the families whose movements carry an arrival date."""
    rates = read.daily_rates(tables["rates"], odate)
    return [
        families.sit(read.transfers(tables["transfers"], odate, datem), rates),
        families.cie(read.collections_by_agreement(tables["collections"], odate, datem), rates),
        families.tib_dem(read.cheques(tables["cheques"], odate, datem), read.cheque_deposits(tables["deposits"], odate, datem), rates),
    ]


def keep_delivery(tables: Mapping[str, DataFrame], path: str, odate: str, datem: str, after: str | None = None) -> int:
    """Sums of the movements that arrived after ``after`` and up to ``datem``, kept as partition ``datem`` below ``path``.

    Running it again replaces that partition.  All keys are kept, those without a concept too, as the catalogue may name
    them later.  Returns the number of sums.
    """
    sums = detail_sums(late_sources(arrived_after(tables, after), odate, datem))
    # One width for every delivery, whatever the sources multiply.
    kept = sums.withColumns({"amount": F.col("amount").cast("decimal(38,12)"), "datem": as_date(datem)})
    return replace_partition(kept, f"{path}/{odate}", "datem", datem)


def month_sums(spark: SparkSession, path: str, odate: str, datem: str) -> DataFrame:
    """Kept sums of all deliveries up to ``datem``, one row per account and key."""
    kept = read_zone(spark, f"{path}/{odate}").where(F.col("datem") <= as_date(datem))
    return kept.groupBy(*KEYS).agg(F.sum("amount").alias("amount"), F.sum("operations").alias("operations"))


def restated_facts(
    spark: SparkSession, path: str, accounts: DataFrame, catalogue: DataFrame, odate: str, datem: str, specs: list[ConceptFamily]
) -> DataFrame:
    """Fact rows of the month from kept sums: what the full run over all movements up to ``datem`` gives."""
    sums = month_sums(spark, path, odate, datem)
    # The scale of the full run, so that a product with the number of account versions loses no place.
    sums = known_concepts(sums.withColumn("amount", F.col("amount").cast("decimal(23,12)")), catalogue)
    held = keep_open_accounts(sums, open_account_copies(accounts, odate))
    return roll_up(amount_and_count_rows(held), catalogue, specs, odate)
