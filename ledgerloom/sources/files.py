"""File readers: delimited text in all its variants, Parquet, control files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the directory name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = False,
    quote: str = '"',
    escape: str | None = None,
) -> DataFrame:
    """CSV under a declared schema; a malformed record fails the job.

    ``multi_line`` is off unless values may hold line breaks: it makes a file one
    task, while plain files are split.  A byte-order mark is skipped by Spark.
    """
    options = {"sep": sep, "header": header, "mode": "FAILFAST", "quote": quote}
    if multi_line:
        options["multiLine"] = True
    if escape:
        options["escape"] = escape
    return spark.read.schema(schema).options(**options).csv(paths)


def read_text_columns(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = ",",
    types: dict[str, str] | None = None,
    **options: object,
) -> DataFrame:
    """CSV with every column as text, so that codes keep their leading zeros.

    ``types`` casts the named columns; nothing is inferred.
    """
    df = spark.read.options(header=True, sep=sep, inferSchema=False, **options).csv(paths)
    wanted = types or {}
    return df.select(
        *[F.col(c).cast(wanted[c]).alias(c) if c in wanted else F.col(c) for c in df.columns]
    )


def read_padded(spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = "|") -> DataFrame:
    """Space-padded table print-outs with ``null`` written out as a word."""
    return (
        spark.read.schema(schema)
        .options(
            sep=sep,
            header=True,
            ignoreLeadingWhiteSpace=True,
            ignoreTrailingWhiteSpace=True,
            nullValue="null",
            mode="FAILFAST",
        )
        .csv(paths)
    )


def read_zone(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """A stored zone table.

    The raw zone is Avro where the Avro module is on the class path; Parquet is
    the default.  Types are those of the files: nothing is converted silently.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_control(spark: SparkSession, path: str, sep: str = "|", position: int = 3) -> DataFrame:
    """Expected row count kept in a control file: one row, column ``expected``.

    ``position`` counts from 1.
    """
    parts = F.split(F.col("value"), "\\Q" + sep + "\\E")
    return (
        spark.read.text(path)
        .where(F.trim("value") != "")
        .select(F.trim(F.get(parts, position - 1)).cast("bigint").alias("expected"))
    )


def read_records(spark: SparkSession, paths: str | list[str], separator: str = ";") -> DataFrame:
    """Text files cut at a record separator: ``file``, ``offset``, ``value``.

    ``offset`` grows with the position of the record inside its file.  Spark splits
    files by byte ranges in order, so the id it gives out is such an offset; it is
    an order, not a gapless count.
    """
    return spark.read.text(paths, lineSep=separator).select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("offset"),
        F.col("value"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the store holds a file or folder of this name."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def partition_exists(df: DataFrame, column: str, value: object) -> bool:
    """Whether a partition holds rows; the scan is pruned to that directory."""
    return not df.where(F.col(column) == F.lit(value)).limit(1).isEmpty()


def partitions_present(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """``value, present`` for each asked partition value, from one pruned scan."""
    kind = df.schema[column].dataType
    asked = df.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(v).cast(kind) for v in values])).alias("value")
    )
    found = (
        df.where(F.col(column).isin(*[F.lit(v).cast(kind) for v in values]))
        .select(F.col(column).alias("value"), F.lit(True).alias("found"))
        .distinct()
    )
    return asked.join(found, "value", "left").select(
        "value", F.coalesce("found", F.lit(False)).alias("present")
    )


def listed_partitions(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``value, files, bytes`` of every partition directory of ``column`` that holds a file, from the listing alone.

    No data file is opened.  A directory without files, or with empty ones only, is no partition; the value of a null
    partition is null.  Values are text, as in the directory's name.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .where(F.col("length") > 0)
        .select("path", "length")
    )
    raw = F.regexp_extract("path", f"/{re.escape(column)}=([^/]*)/", 1)
    # Directory names hold special characters as in addresses, where a plus sign stands for itself.
    value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    found = listed.where(F.col("path").contains(f"/{column}="))
    named = found.select(F.when(raw != NULL_PARTITION, value).alias("value"), "length")
    return named.groupBy("value").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def listed_partitions_present(spark: SparkSession, path: str, column: str, values: list[str]) -> DataFrame:
    """:func:`partitions_present` of text values from the listing: ``value, present``."""
    asked = spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias("value"))
    found = listed_partitions(spark, path, column).select("value", F.lit(True).alias("found"))
    return asked.join(found, "value", "left").select("value", F.coalesce("found", F.lit(False)).alias("present"))
