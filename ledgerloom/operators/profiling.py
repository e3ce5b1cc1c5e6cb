"""Column profiles, each computed for all columns in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import required_columns

# Fixed value: day, month and year with slashes.
SLASHED_DATE = r"^\d{2}/\d{2}/\d{4}$"


def format_audit(df: DataFrame, columns: list[str], pattern: str = SLASHED_DATE) -> DataFrame:
    """Per column: rows, nulls, values in the format and values not in it."""
    counters = [F.count("*").alias("rows")]
    for c in columns:
        counters.append(F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"))
        counters.append(F.count_if(F.col(c).rlike(pattern)).alias(f"good_{c}"))
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("rows"),
                F.col(f"nulls_{c}").alias("nulls"),
                F.col(f"good_{c}").alias("matching"),
                (F.col("rows") - F.col(f"nulls_{c}") - F.col(f"good_{c}")).alias("not_matching"),
            )
            for c in columns
        ]
    )
    return df.agg(*counters).select(F.inline(lines))


def off_format_values(df: DataFrame, columns: list[str], pattern: str = SLASHED_DATE) -> DataFrame:
    """The values outside the format with their number of rows: ``column_name, value, n``."""
    long = _long(df, columns).where(F.col("value").isNotNull() & ~F.col("value").rlike(pattern))
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def null_positions(df: DataFrame, columns: list[str], row_id: str) -> DataFrame:
    """Row ids at which a column is null: ``column_name, row_id``."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.select(F.explode(gaps).alias("column_name"), F.col(row_id).alias("row_id"))


def null_audit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Nulls of the schema's required columns; ``present`` is false for absent ones."""
    names = required_columns(schema)
    here = set(df.columns)
    counters = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in names if c in here]
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(c in here).alias("present"),
                (F.col(f"nulls_{c}") if c in here else F.lit(None).cast("bigint")).alias("nulls"),
            )
            for c in names
        ]
    )
    return df.agg(F.count("*").alias("rows"), *counters).select(F.inline(lines))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls of every column: ``column_name, nulls``."""
    lines = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    )
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).select(
        F.inline(lines)
    )


def rows_with_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return df.select(F.inline(cells))


def distinct_values(df: DataFrame, by: Column | str, value: Column | str) -> DataFrame:
    """Distinct values per field with length and rows: ``field, value, length, n``.

    One row per distinct value, so a field with very many values is never gathered
    into one task.
    """
    field = F.col(by) if isinstance(by, str) else by
    found = F.col(value) if isinstance(value, str) else value
    return (
        df.select(field.alias("field"), found.cast("string").alias("value"))
        .groupBy("field", "value")
        .agg(F.count("*").alias("n"))
        .select("field", "value", F.length("value").alias("length"), "n")
    )


def value_digest(df: DataFrame, by: Column | str, value: Column | str) -> DataFrame:
    """Per field: number of distinct values and the longest one's length."""
    return distinct_values(df, by, value).groupBy("field").agg(
        F.count("*").alias("distinct_values"), F.max("length").alias("max_length")
    )


def column_digest(df: DataFrame, columns: list[str]) -> DataFrame:
    """:func:`value_digest` over several columns of one frame."""
    return value_digest(_long(df, columns), "column_name", "value")


def required_present(df: DataFrame, schema: T.StructType) -> list[str]:
    """Required schema columns that the frame lacks."""
    return [c for c in required_columns(schema) if c not in df.columns]


def shape(df: DataFrame) -> tuple[int, int]:
    """Number of rows and of columns."""
    return df.count(), len(df.columns)


def preview(df: DataFrame, rows: int = 4, order: list[str] | None = None) -> DataFrame:
    """The first rows in an order, or as Spark meets them without one."""
    return (df.orderBy(*order) if order else df).limit(rows)
