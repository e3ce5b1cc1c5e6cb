"""Declared table schemas: JSON files in, ``StructType`` out, frames checked against them.

A schema file is a JSON record with ``name``, ``partitions`` and ``fields``; a
field has ``name``, ``type``, ``logicalFormat``, ``metadata`` and perhaps
``format``.  A bare string as ``type`` means the column must not be null, a list
such as ``["string", "null"]`` means that it may be.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type words of the schema files and their Spark types.
TYPE_WORDS = {
    "string": "string",
    "date": "date",
    "int32": "int",
    "int64": "bigint",
    "double": "double",
    "timestamp": "timestamp",
}

# The seven-column output fact.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("analytic_concept_id", T.StringType()),
        T.StructField("sender_application_id", T.StringType()),
        T.StructField("commercial_product_type", T.StringType()),
        T.StructField("commercial_subproduct_type", T.StringType()),
        T.StructField("analytic_concept_amount", T.DecimalType(17, 2)),
        T.StructField("cutoff_date", T.DateType()),
    ]
)


class SchemaMismatch(ValueError):
    """A frame does not meet its declared schema; the message lists every violation."""


def _spark_type(word: str) -> T.DataType:
    return T.DataType.fromDDL(TYPE_WORDS.get(word, word))


def read_table_schema(source: str | Path | dict, raw: bool = False) -> T.StructType:
    """Schema file (path or parsed JSON) as a ``StructType``.

    ``raw=True`` types every column ``string``, as in the raw zone.  The field's
    ``logicalFormat``, ``format`` and ``metadata`` flag stay in the field metadata.
    """
    record = source if isinstance(source, dict) else json.loads(Path(source).read_text("utf-8-sig"))
    fields = []
    for item in record["fields"]:
        declared = item["type"]
        words = [declared] if isinstance(declared, str) else list(declared)
        value_word = next(w for w in words if w != "null")
        notes = {
            "logicalFormat": item.get("logicalFormat", ""),
            "injected": bool(item.get("metadata", False)),
        }
        if "format" in item:
            notes["format"] = item["format"]
        spark_type = T.StringType() if raw else _spark_type(value_word)
        fields.append(T.StructField(item["name"], spark_type, "null" in words, notes))
    return T.StructType(fields)


def read_spark_schema(source: str | Path | dict) -> T.StructType:
    """``StructType`` kept in Spark's own JSON form: a file, or the parsed record."""
    record = source if isinstance(source, dict) else json.loads(Path(source).read_text("utf-8-sig"))
    return T.StructType.fromJson(record)


def fields_where(schema: T.StructType, keep: Callable[[T.StructField], bool]) -> list[str]:
    """Names of the fields for which ``keep`` holds, in schema order."""
    return [f.name for f in schema.fields if keep(f)]


def required_columns(schema: T.StructType) -> list[str]:
    return fields_where(schema, lambda f: not f.nullable)


def injected_columns(schema: T.StructType) -> list[str]:
    """Columns absent from the landing file and added at ingestion."""
    return fields_where(schema, lambda f: bool(f.metadata.get("injected")))


def columns_of_format(schema: T.StructType, logical: str) -> list[str]:
    """Columns whose logical format is ``logical``, e.g. ``DATE``."""
    return fields_where(schema, lambda f: f.metadata.get("logicalFormat") == logical)


def landing_schema(schema: T.StructType) -> T.StructType:
    """All-string schema of the landing file: the injected columns left out."""
    injected = set(injected_columns(schema))
    return T.StructType(
        [
            T.StructField(f.name, T.StringType(), True, f.metadata)
            for f in schema.fields
            if f.name not in injected
        ]
    )


def max_lengths(schema: T.StructType) -> dict[str, int]:
    """Length limits declared by ``ALPHANUMERIC(n)``."""
    limits = {}
    for f in schema.fields:
        found = re.fullmatch(r"ALPHANUMERIC\((\d+)\)", f.metadata.get("logicalFormat", ""))
        if found:
            limits[f.name] = int(found.group(1))
    return limits


def with_overrides(schema: T.StructType, overrides: dict[str, str]) -> T.StructType:
    """The schema with some columns given another type (DDL word)."""
    return T.StructType(
        [
            T.StructField(
                f.name,
                T.DataType.fromDDL(overrides[f.name]) if f.name in overrides else f.dataType,
                f.nullable,
                f.metadata,
            )
            for f in schema.fields
        ]
    )


def structure_violations(df: DataFrame, schema: T.StructType) -> list[str]:
    """Missing, extra and wrongly typed columns (no job runs)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    problems = [f"missing column {name}" for name in want if name not in have]
    problems += [f"unexpected column {name}" for name in have if name not in want]
    problems += [
        f"column {name} is {have[name].simpleString()}, expected {want[name].simpleString()}"
        for name in want
        if name in have and have[name] != want[name]
    ]
    return problems


def null_violations(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Null counts of columns that must not be null, all in one pass."""
    names = [c for c in columns if c in df.columns]
    if not names:
        return []
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]).first()
    return [f"column {c} has {counts[c]} null values" for c in names if counts[c]]


def conform(df: DataFrame, schema: T.StructType, check_nulls: bool = True) -> DataFrame:
    """The frame in schema order, or one error that lists every violation.

    ``check_nulls`` runs one counting job over the required columns.  Without it
    the required columns are guarded inside the plan: a null fails the write.
    """
    problems = structure_violations(df, schema)
    required = required_columns(schema)
    if check_nulls:
        problems += null_violations(df, required)
    if problems:
        raise SchemaMismatch("; ".join(problems))

    def guarded(name: str) -> Column:
        if check_nulls or name not in required:
            return F.col(name)
        fail = F.raise_error(F.lit(f"column {name} must not be null"))
        return F.coalesce(F.col(name), fail.cast(schema[name].dataType)).alias(name)

    return df.select(*[guarded(f.name) for f in schema.fields])


def as_fact(df: DataFrame) -> DataFrame:
    """The seven output columns, in order and in their declared types."""
    return df.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in FACT_SCHEMA.fields]
    )
