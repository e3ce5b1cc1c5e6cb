"""Places in files: exact line and row numbers, and records made of several lines.

Spark cuts a file into splits and reads each in order, and gives consecutive ids to the rows of a split.  Rows per split are counted
and summed up over the splits before; a row's number is that sum plus its place in the split.  Rows stay where they
are read, only one line per split moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines of one record that are gathered; a longer one is not a record.
MOST_LINES = 100


def _marked(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )


def _earlier(partition: str, order: str) -> Window:
    return Window.partitionBy(partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _placed(df: DataFrame, across_files: bool = False) -> DataFrame:
    """Columns of ``df``, then ``file, split, row_number``."""
    marked = _marked(df)
    splits = marked.groupBy("_file", "_block").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    summed = splits.withColumn("_before", F.coalesce(F.sum("_rows").over(_earlier("_file", "_block")), F.lit(0)))
    if across_files:
        sizes = splits.groupBy("_file").agg(F.sum("_rows").alias("_size"))
        ordered = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
        files = sizes.select("_file", F.coalesce(F.sum("_size").over(ordered), F.lit(0)).alias("_base"))
        summed = summed.join(files, "_file").withColumn("_before", F.col("_before") + F.col("_base"))
    # The path and start of a split are never null, so the join keeps every row.
    placed = marked.join(summed.drop("_rows"), ["_file", "_block"])
    number = F.col("_before") + F.col("_id") - F.col("_first")
    return placed.select(*df.columns, F.col("_file").alias("file"), F.col("_block").alias("split"), number.alias("row_number"))


def in_file_order(df: DataFrame, across_files: bool = False) -> DataFrame:
    """The frame with ``file`` and ``row_number``, which counts from 0 in the order of the file.

    ``df`` must come straight from a reader, without a filter or an order since.  ``across_files`` goes on counting from file
    to file, by path; one row per file is then ordered in one task.
    """
    return _placed(df, across_files).drop("split")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text files with their numbers from 0: ``value, file, row_number``."""
    return in_file_order(spark.read.text(paths))


def gathered_records(spark: SparkSession, paths: str | list[str], border: Column, most_lines: int = MOST_LINES) -> DataFrame:
    """Records of several lines: ``file, first_line, size, lines``.

    A line where ``border`` holds (on column ``value``) ends one record and starts the next; it is the first of the new record's
    ``lines``, as is the first line of a file.  The last border before each split is carried into it, so that a record may be
    cut by any number of splits.  A record of more than ``most_lines`` lines has its ``size`` but no lines, and is never
    gathered in one place.
    """
    lines = _placed(spark.read.text(paths))
    starts = F.when(border | (F.col("row_number") == 0), F.col("row_number"))
    marked = lines.withColumn("start", starts)
    last = marked.groupBy("file", "split").agg(F.max("start").alias("last"))
    carried = last.select("file", "split", F.max("last").over(_earlier("file", "split")).alias("carry"))
    so_far = Window.partitionBy("file", "split").orderBy("row_number")
    running = marked.withColumn("start", F.max("start").over(so_far)).join(carried, ["file", "split"])
    placed = running.withColumn("start", F.coalesce("start", "carry"))
    near = F.when(F.col("row_number") - F.col("start") < most_lines, F.struct("row_number", "value"))
    grouped = placed.groupBy("file", F.col("start").alias("first_line")).agg(F.count("*").alias("size"), F.array_sort(F.collect_list(near)).alias("found"))
    whole = F.when(F.col("size") <= most_lines, F.col("found.value"))
    return grouped.select("file", "first_line", "size", whole.alias("lines"))

