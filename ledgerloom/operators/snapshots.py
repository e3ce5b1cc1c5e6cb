"""Snapshot tables: several dated versions per key, readers want the newest one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.sources.files import listed_partitions, read_zone

# The status of a closed contract and the account columns read.
CLOSED = "T"
ACCOUNT_COLUMNS = (
    "account_id",
    "commercial_product_type",
    "commercial_subproduct_type",
    "gl_branch_id",
)


def newest_versions(
    df: DataFrame, keys: list[str], version: str, as_of: str | None = None
) -> DataFrame:
    """Rows whose ``version`` date is the newest (up to ``as_of``) of their key.

    Ties are all kept and rows with a null key drop out.  The newest date per key
    is aggregated on the map side first, so no task ever sees all versions of a
    key; the join back hashes on key *and* date, and a partition that is still
    skewed is split by adaptive execution.
    """
    bounded = df.where(F.col(version) <= as_date(as_of)) if as_of else df
    newest = bounded.groupBy(*[F.col(k).alias(f"_newest_{k}") for k in keys]).agg(
        F.max(version).alias("_newest_version")
    )
    same = reduce(
        lambda a, b: a & b,
        [F.col(k) == F.col(f"_newest_{k}") for k in keys],
        F.col(version) == F.col("_newest_version"),
    )
    return bounded.join(newest, same, "inner").select(*df.columns)


def open_accounts(accounts: DataFrame, odate: str, columns: tuple[str, ...] = ACCOUNT_COLUMNS) -> DataFrame:
    """Newest account versions up to ``odate`` whose contract is not closed.

    The status is tested after the newest version is picked: an account whose
    newest version is closed disappears, and so does one with a null status.
    """
    newest = newest_versions(accounts, ["account_id"], "cutoff_date", odate)
    return newest.where(F.col("contract_status_type") != CLOSED).select(*columns)


def newest_copies(
    df: DataFrame,
    key: str,
    version: str,
    counted: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How many rows the newest version of each key has: ``key, *carry, copies``.

    The summary of :func:`newest_versions` for joins that only filter and repeat the
    other side.  It is built from aggregations alone, which all start on the map
    side.  ``counted`` restricts the rows that count without changing which version
    is the newest; keys left with none drop out.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(version).isNotNull())
    tally = F.count_if(counted) if counted is not None else F.count("*")
    per_version = rows.groupBy(key, version, *carry).agg(tally.alias("copies"))
    if carry:
        newest = newest_versions(per_version, [key], version).select(key, *carry, "copies")
    else:
        newest = per_version.groupBy(key).agg(F.max_by("copies", version).alias("copies"))
    return newest.where(F.col("copies") > 0)


def open_account_copies(
    accounts: DataFrame, odate: str, carry: tuple[str, ...] = (), dedupe: bool = False
) -> DataFrame:
    """How many rows :func:`open_accounts` has per account: ``account_id, *carry, copies``.

    Joining movements to the open accounts only filters them and repeats a
    movement once per tied version.  The count says the same in one row per
    account, so that movements can be summed before they meet the accounts.
    ``dedupe=True`` counts a tied account once.
    """
    bounded = accounts.where(F.col("cutoff_date") <= as_date(odate))
    still_open = F.col("contract_status_type") != CLOSED
    newest = newest_copies(bounded, "account_id", "cutoff_date", still_open, carry)
    return newest.withColumn("copies", F.lit(1).cast("bigint")) if dedupe else newest


def newest_date(df: DataFrame, column: str, as_of: str | None = None) -> DataFrame:
    """One row, one column: the newest date, optionally bounded by ``as_of``."""
    bounded = df.where(F.col(column) <= as_date(as_of)) if as_of else df
    return bounded.agg(F.max(column).alias(column))


def rows_at_newest(df: DataFrame, column: str, as_of: str | None = None) -> DataFrame:
    """Rows dated at the table's newest date, optionally bounded by ``as_of``.

    The date is a scalar subquery: it runs first, and the scan of a table
    partitioned by ``column`` is pruned to that one partition.
    """
    return df.where(F.col(column) == newest_date(df, column, as_of).scalar())


def newest_partition(spark: SparkSession, path: str, column: str, as_of: str | None = None) -> DataFrame:
    """:func:`newest_date` of a stored table partitioned by ``column``, from the names of its directories.

    No data file is opened.  Directories without files do not count; a null partition has no date.
    """
    dates = listed_partitions(spark, path, column).select(F.col("value").cast("date").alias(column))
    return newest_date(dates, column, as_of)


def rows_at_newest_partition(spark: SparkSession, path: str, column: str, as_of: str | None = None) -> DataFrame:
    """:func:`rows_at_newest` of a stored table partitioned by ``column``: only the newest directory is opened."""
    newest = newest_partition(spark, path, column, as_of).scalar()
    return read_zone(spark, path).where(F.col(column) == newest)


def current_catalogue(catalogue: DataFrame, as_of: str | None = None) -> DataFrame:
    """The concept catalogue at its newest cutoff (not bounded unless asked)."""
    return rows_at_newest(catalogue, "cutoff_date", as_of)


def coded_concepts(catalogue: DataFrame) -> DataFrame:
    """Catalogue rows that carry a concept code."""
    return catalogue.where(F.col("data_code_id").isNotNull())


def catalogue_of(catalogue: DataFrame, operation: str) -> DataFrame:
    """Catalogue rows of one operation group."""
    return catalogue.where(F.col("bg_operation_id") == operation)


def join_accounts(movements: DataFrame, accounts: DataFrame, key: Column, how: str = "inner") -> DataFrame:
    """Movements of the given open accounts, movement columns only.

    ``how="inner"`` repeats a movement per tied account version, as the plain join
    does; ``how="left_semi"`` keeps it once.
    """
    ids = accounts.select(F.col("account_id").alias("_account"))
    return movements.join(ids, key == F.col("_account"), how).select(*movements.columns)
