"""Zone jobs: landing file to raw table to typed master table, and the balance export."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.operators.lookups import join_filtered
from ledgerloom.operators.transforms import (
    Transform,
    cast_to_schema,
    literal,
    pipeline,
    replace_text,
    select_columns,
    sql_filter,
    trim_columns,
)
from ledgerloom.schemas import columns_of_format, conform
from ledgerloom.sinks.tables import create, overwrite
from ledgerloom.sources.files import read_delimited

# Banking types of the exported branches and the exported columns.
EXPORTED_BANKING = ("9047", "9105")
BALANCE_COLUMNS = [
    "gl_date",
    "gl_branch_id",
    "manager_id",
    "customer_id",
    "contract_id",
    "account_id",
    "sender_application_id",
    "commercial_product_type",
    "commercial_subproduct_type",
    "origin_currency_id",
    "account_opening_date",
    "current_contract_expiration_date",
    "contract_duration_number",
    "current_balance_amount",
    "current_bal_local_curncy_amount",
    "overdue_balance_amount",
    "overdue_bal_local_curncy_amount",
    "cutoff_date",
    "avg_bal_orig_curncy_amount",
    "total_average_balance_amount",
]


def landing_to_raw(
    landing: DataFrame,
    injected: Mapping[str, str],
    raw_schema: T.StructType,
    keep: str | None = None,
) -> DataFrame:
    """All-text landing rows with the injected date columns, in raw schema order."""
    steps: list[Transform] = [literal(name, value) for name, value in injected.items()]
    if keep:
        steps.append(sql_filter(keep))
    return conform(pipeline(landing, *steps), raw_schema, check_nulls=False)


def declared_date_formats(raw_schema: T.StructType) -> dict[str, str]:
    """Parse format of each date column whose raw schema names one other than ISO."""
    return {
        c: raw_schema[c].metadata["format"]
        for c in columns_of_format(raw_schema, "DATE")
        if raw_schema[c].metadata.get("format") not in (None, "yyyy-MM-dd")
    }


def raw_to_master(
    raw: DataFrame,
    master_schema: T.StructType,
    keep: str | None = None,
    date_formats: Mapping[str, str] | None = None,
    clean: bool = True,
) -> DataFrame:
    """One load of the raw table, cleaned and cast strictly to the master schema.

    ``clean`` trims every column and takes out line breaks.  The casts follow from
    the master schema; a value that does not fit fails the job.  The filter sits on
    the partition column, so only that partition is read.
    """
    steps: list[Transform] = [sql_filter(keep)] if keep else []
    if clean:
        steps += [trim_columns(".*"), replace_text(".*", {r"\n": ""})]
    steps.append(cast_to_schema(master_schema, date_formats))
    return conform(pipeline(raw, *steps), master_schema, check_nulls=False)


def delimited_to_table(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    target: str,
    partition: str,
    sep: str = "|",
    replace: bool = False,
) -> None:
    """Delimited files under a declared schema to a partitioned Parquet table.

    An existing table is an error unless ``replace``.
    """
    write = overwrite if replace else create
    write(read_delimited(spark, paths, schema, sep=sep), target, partition)


def balance_export(balances: DataFrame, branches: DataFrame, gl_date: str, branch_cutoff: str) -> DataFrame:
    """Balances of one accounting date at the branches of the exported banking types."""
    kinds = ", ".join(f"'{b}'" for b in EXPORTED_BANKING)
    joined = join_filtered(
        balances.where(f"gl_date = DATE '{gl_date}'"),
        branches,
        {"gl_branch_id": "branch_id"},
        right_filter=f"cutoff_date = DATE '{branch_cutoff}' AND banking_type IN ({kinds})",
        select=BALANCE_COLUMNS,
    )
    return joined.transform(select_columns(*BALANCE_COLUMNS))
