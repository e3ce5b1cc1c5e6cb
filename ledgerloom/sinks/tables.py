"""Table writers.

Where a frame holds many partition values, its files are balanced by the
``rebalance`` hint: adaptive execution merges small shuffle partitions and splits
large ones, so one date with most of the rows is still written by many tasks.
``files`` forces an output file count: the rows are dealt out to that many writing
tasks while everything before keeps its own parallelism.  Leave it out for large
tables.
"""

from __future__ import annotations

import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

def _arranged(df: DataFrame, partition: str | None, files: int | None) -> DataFrame:
    if files:
        return df.repartition(files)
    return df.hint("rebalance", partition) if partition else df


def append_partitioned(
    df: DataFrame, path: str, partition: str, fmt: str = "parquet", files: int | None = None
) -> None:
    """Rows added to a partitioned table."""
    _arranged(df, partition, files).write.format(fmt).mode("append").partitionBy(partition).save(path)


def overwrite(
    df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet", files: int | None = None
) -> None:
    """The whole table replaced."""
    writer = _arranged(df, partition, files).write.format(fmt).mode("overwrite")
    (writer.partitionBy(partition) if partition else writer).save(path)


def create(
    df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet", files: int | None = None
) -> None:
    """A new table; fails when the path exists."""
    writer = _arranged(df, partition, files).write.format(fmt).mode("errorifexists")
    (writer.partitionBy(partition) if partition else writer).save(path)


def store_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """A table of the session's catalogue dealt to ``buckets`` files by ``key`` and sorted by it, as a frame.

    Joins and groupings by the key read it without an exchange.  ``buckets`` should not be below the session's shuffle partitions, or
    Spark deals the table anew.  Rows are dealt before they are written, so a bucket is one file.
    """
    spread = df.repartition(buckets, key)
    writer = spread.write.bucketBy(buckets, key).sortBy(key)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return df.sparkSession.table(table)


def replace_partition(
    df: DataFrame,
    path: str,
    partition: str,
    value: str | list[str],
    fmt: str = "parquet",
    files: int | None = None,
) -> int:
    """One or several partitions replaced, all others untouched; running it again changes nothing.

    A row of any other partition value fails the write, and the old files stay: the
    guard is part of the plan and files only move into place when the job commits.
    A value without rows empties its partition.  Files are balanced by size unless
    ``files`` sets their number.  Returns the rows written.
    """
    values = [value] if isinstance(value, str) else list(value)
    for v in values:
        if not re.fullmatch(r"[\w.\-]+", v):
            raise ValueError(f"partition value {v!r} cannot be a directory name")
    kind = df.schema[partition].dataType
    typed = [F.lit(v).cast(kind) for v in values]
    wrong = F.raise_error(
        F.concat(
            F.lit(f"row outside {partition}={','.join(values)}: "),
            F.coalesce(F.col(partition).cast("string"), F.lit("null")),
        )
    )
    guarded = df.withColumn(
        partition, F.when(F.col(partition).isin(*typed), F.col(partition)).otherwise(wrong.cast(kind))
    )
    seen = Observation("replace_partition")
    counts = [F.count_if(F.col(partition) == t).alias(f"rows_{i}") for i, t in enumerate(typed)]
    watched = guarded.observe(seen, *counts)
    (
        (watched.repartition(files) if files else watched.hint("rebalance"))
        .write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .save(path)
    )
    rows = _observed(seen, guarded, len(values))
    for v, n in zip(values, rows, strict=True):
        if n == 0:
            _delete(df.sparkSession, f"{path.rstrip('/')}/{partition}={v}")
    return sum(rows)


def _observed(seen: Observation, df: DataFrame, values: int) -> list[int]:
    """Rows per value.  The optimiser drops the counters of a frame it proves empty; any other failure is raised."""
    try:
        return [seen.get[f"rows_{i}"] for i in range(values)]
    except Py4JJavaError:
        if not df.isEmpty():
            raise
        return [0] * values


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    if fs.exists(target):
        fs.delete(target, True)


def export_text(
    df: DataFrame,
    directory: str,
    file_name: str | None,
    sep: str = ",",
    header: bool = True,
    byte_order_mark: bool = False,
) -> list[str]:
    """Delimited export; the names of the files written are returned.

    Values keep their spaces, and a quote inside a quoted value is doubled.  With a
    ``file_name`` one task writes that single file, so it is for results of a size
    one machine should carry.  With None all tasks write and the part files keep the
    names Spark gives them.
    """
    if byte_order_mark and header:
        df = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0])
    shaped = df.repartition(1) if file_name else df
    shaped.write.mode("overwrite").options(
        sep=sep,
        header=header,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(directory)
    fs, target = _hadoop(df.sparkSession, directory)
    parts = sorted(
        s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName().startswith("part-")
    )
    if not file_name:
        return parts
    path_class = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.rename(path_class(f"{directory}/{parts[0]}"), path_class(f"{directory}/{file_name}"))
    return [file_name]
