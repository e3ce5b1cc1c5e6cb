"""Runnable jobs: stored tables or files in, one partition or one export out.

Each job reads, plans and writes; running it again for the same date replaces what
it wrote before.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import quality
from ledgerloom.plans import ingest, profit
from ledgerloom.schemas import FACT_SCHEMA, conform, landing_schema, read_table_schema
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files

# The inputs of the two profit parts, as keys of ``paths``.
FIRST_PART_TABLES = (
    "earlier_facts",
    "accounts",
    "catalogue",
    "general_movements",
    "commissions",
    "branch_commissions",
)
SECOND_PART_TABLES = (
    "accounts",
    "catalogue",
    "rates",
    "transfers",
    "collections",
    "cheques",
    "deposits",
    "debits",
    "issuances",
    "dispersals",
    "host_to_host",
    "payrolls",
)


def load_tables(spark: SparkSession, paths: Mapping[str, str], names: tuple[str, ...]) -> dict[str, DataFrame]:
    """The named inputs as frames; nothing is read yet."""
    missing = [n for n in names if n not in paths]
    if missing:
        raise KeyError(f"no path for {', '.join(missing)}")
    return {n: files.read_zone(spark, paths[n]) for n in names}


def first_part_job(
    spark: SparkSession, paths: Mapping[str, str], odate: str, target: str, files_count: int | None = None
) -> None:
    """Writes the first part of the profit facts as an intermediate table.

    In all table jobs files are balanced by size, unless ``files_count`` sets their number.
    """
    facts = profit.base_concepts(load_tables(spark, paths, FIRST_PART_TABLES), odate)
    sinks.overwrite(facts if files_count else facts.hint("rebalance"), target, files=files_count)


def second_part_job(
    spark: SparkSession,
    paths: Mapping[str, str],
    odate: str,
    datem: str,
    first_part: str,
    target: str,
    partition: str = "cutoff_date",
    files_count: int | None = None,
) -> int:
    """Adds the rolled-up families to the stored first part; replaces one cutoff.

    Earlier facts of another cutoff make the job fail, as they do not belong to the
    partition.  Returns the rows written.
    """
    tables = load_tables(spark, paths, SECOND_PART_TABLES)
    facts = profit.profit_facts(tables, odate, datem, base=files.read_zone(spark, first_part))
    checked = conform(facts, FACT_SCHEMA, check_nulls=False)
    return sinks.replace_partition(checked, target, partition, odate, files=files_count)


def landing_job(
    spark: SparkSession,
    landing: str | list[str],
    raw_path: str,
    schema_file: str,
    injected: Mapping[str, str],
    partition: str,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = False,
    fmt: str = "parquet",
    files_count: int | None = None,
) -> int:
    """Landing files to one partition of the all-text raw table."""
    raw_schema = read_table_schema(schema_file, raw=True)
    rows = files.read_delimited(
        spark, landing, landing_schema(raw_schema), sep=sep, header=header, multi_line=multi_line
    )
    value = injected[partition]
    raw = ingest.landing_to_raw(rows, injected, raw_schema, keep=f"{partition} = '{value}'")
    return sinks.replace_partition(raw, raw_path, partition, value, fmt=fmt, files=files_count)


def master_job(
    spark: SparkSession,
    raw_path: str,
    master_path: str,
    raw_schema_file: str,
    master_schema_file: str,
    partition: str,
    value: str,
    clean: bool = True,
    date_formats: Mapping[str, str] | None = None,
    fmt: str = "parquet",
    files_count: int | None = None,
) -> int:
    """One partition of the raw table to the typed master table.

    Dates are read in the formats the raw schema declares, changed or completed by
    ``date_formats``.
    """
    raw_schema = read_table_schema(raw_schema_file, raw=True)
    raw = files.read_zone(spark, raw_path, fmt, raw_schema)
    formats = {**ingest.declared_date_formats(raw_schema), **(date_formats or {})}
    master = ingest.raw_to_master(
        raw,
        read_table_schema(master_schema_file),
        keep=f"{partition} = '{value}'",
        date_formats=formats,
        clean=clean,
    )
    return sinks.replace_partition(master, master_path, partition, value, files=files_count)


def quality_job(
    df: DataFrame,
    rules: list[quality.Rule],
    target: str,
    subset: str | None = None,
    refused: str | None = None,
) -> DataFrame:
    """Stores the report of the rules and stops when a critical one is KO.

    The rows that fail a rule ``with_refusals`` are stored below ``refused`` before that.
    """
    kept = [r for r in rules if r.with_refusals]
    if kept and not refused:
        raise ValueError("rules with refusals need a place to store them")
    if kept:
        sinks.overwrite(quality.refusals(df, kept, subset).hint("rebalance"), refused)
    sinks.overwrite(quality.evaluate(df, rules, subset), target, files=1)
    return quality.enforce(files.read_zone(df.sparkSession, target))


def balance_export_job(
    spark: SparkSession,
    balances: str,
    branches: str,
    gl_date: str,
    branch_cutoff: str,
    directory: str,
    file_name: str,
) -> list[str]:
    """The balances of the exported branches as a delimited file."""
    rows = ingest.balance_export(
        files.read_zone(spark, balances), files.read_zone(spark, branches), gl_date, branch_cutoff
    )
    return sinks.export_text(rows, directory, file_name)
