"""Row numbers over splits and files, records of several lines, partitions from their names."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profiling, snapshots, textmatch
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files, positions
from tests.conftest import plan_of


@pytest.fixture
def small_splits(spark):
    """Splits of some dozen bytes, so that lines and records lie across many of them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _write(folder, **contents):
    os.makedirs(folder, exist_ok=True)
    for name, text in contents.items():
        (folder / f"{name}.txt").write_text(text)
    return str(folder)


def test_lines_are_numbered_over_splits(spark, rows, tmp_path, small_splits):
    wanted = {n: [f"{n} line {i} {'x' * (i % 70)}" for i in range(60)] for n in ("a", "b")}
    path = _write(tmp_path / "t", **{n: "\n".join(v) for n, v in wanted.items()}, empty="")
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    got = positions.read_lines(spark, path)
    assert rows(got, F.regexp_extract("file", r"(\w+)\.txt", 1), "row_number", "value") == sorted(
        ((n, i, line) for n, v in wanted.items() for i, line in enumerate(v)), key=repr
    )
    through = positions.in_file_order(spark.read.text(path), across_files=True)
    assert rows(through, "row_number", "value") == sorted(enumerate(wanted["a"] + wanted["b"]), key=repr)


def test_numbering_moves_no_line_and_needs_no_single_task(spark, tmp_path, small_splits):
    path = _write(tmp_path / "t", a="one\ntwo\n" * 50)
    plan = plan_of(positions.read_lines(spark, path))
    assert "SinglePartition" not in plan and "BroadcastHashJoin" in plan


def test_null_positions_of_delimited_files(spark, rows, tmp_path, small_splits):
    path = _write(tmp_path / "t", a="n,v\n" + "".join(f"{i},{'' if i % 7 == 3 else 'x'}\n" for i in range(50)))
    df = files.read_delimited(spark, path, spark.createDataFrame([], "n int, v string").schema)
    numbered = positions.in_file_order(df)
    assert rows(profiling.null_positions(numbered, ["v"], "row_number"), "row_id") == sorted([(i,) for i in range(50) if i % 7 == 3], key=repr)


BLOCKS = [["What is it?", "this", "that"], ["Alone?"], ["One", "only"], ["Long?", *map(str, range(200))], ["Last?", " a ", "b"]]


@pytest.mark.parametrize("end", ["", "\n", "\n\n \n"])
def test_blocks_cut_by_splits(spark, rows, tmp_path, small_splits, end):
    path = _write(tmp_path / "t", a="\n\n" + "\n \n\n".join("\n".join(b) for b in BLOCKS) + end, b="\n".join(BLOCKS[0]))
    records = positions.gathered_records(spark, path, textmatch.blank_line())
    assert rows(textmatch.split_blocks(records), "questions", "options", "answers") == sorted(
        [(b[0], "\n".join(b[1:]), "") for b in (BLOCKS[0], *BLOCKS[:1], BLOCKS[2], BLOCKS[4])], key=repr
    )
    bad = textmatch.quarantined_blocks(records).collect()
    assert sorted((r.size, r.lines is None) for r in bad) == [(2, False), (202, True)]


def test_marked_records_cut_by_splits(spark, rows, tmp_path, small_splits):
    text = "Fail\nQuestion\nWhich two\tone;two\nQuestion\nno answer\nQuestion\nover\nlines\tand\nmore\nQuestion\ntoo\tmany\ttabs\nQuestion\n Question \nx\ty"
    records = positions.gathered_records(spark, _write(tmp_path / "t", a=text), textmatch.marker_line())
    assert rows(textmatch.split_marked(records), "questions", "options", "answers") == sorted(
        [("Which two", "", "one;two"), ("over\nlines", "", "and\nmore"), ("x", "", "y")], key=repr
    )
    bad = textmatch.quarantined_marked(records)
    assert sorted(r.lines for r in bad.collect()) == sorted([["Fail"], ["Question", "no answer"], ["Question", "too\tmany\ttabs"], ["Question"]])


def test_records_of_no_lines(spark, tmp_path):
    records = positions.gathered_records(spark, _write(tmp_path / "t", a=""), textmatch.blank_line())
    assert textmatch.split_blocks(records).count() == textmatch.quarantined_blocks(records).count() == 0


def test_newest_partition_opens_no_data_file(spark, tmp_path):
    path = str(tmp_path / "t")
    days = ["2022-01-31", "2022-02-28", "2022-03-31", None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "n int, d string").withColumn("d", F.col("d").cast("date"))
    sinks.append_partitioned(df, path, "d")
    os.makedirs(f"{path}/d=2030-01-01")
    open(f"{path}/d=2029-01-01.txt", "w").close()
    os.makedirs(f"{path}/d=2028-01-01")
    open(f"{path}/d=2028-01-01/part-0.parquet", "w").close()
    newest = lambda as_of=None: str(snapshots.newest_partition(spark, path, "d", as_of).first()[0])
    assert newest() == "2022-03-31" and newest("2022-03-30") == "2022-02-28" and newest("2000-01-01") == "None"
    plan = plan_of(snapshots.newest_partition(spark, path, "d"))
    assert "binaryFile" in plan and "parquet" not in plan.lower().replace(".parquet", "")
    listed = {r.value: r.files for r in files.listed_partitions(spark, path, "d").collect()}
    assert listed == {"2022-01-31": 1, "2022-02-28": 1, "2022-03-31": 1, None: 1}
    assert [tuple(r) for r in files.listed_partitions_present(spark, path, "d", ["2022-01-31", "2030-01-01"]).orderBy("value").collect()] == [
        ("2022-01-31", True), ("2030-01-01", False),
    ]


def test_only_the_newest_directory_is_read(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, f"2022-0{1 + i % 3}-01") for i in range(9)], "n int, d string").withColumn("d", F.col("d").cast("date"))
    sinks.append_partitioned(df, path, "d")
    newest = snapshots.rows_at_newest_partition(spark, path, "d", "2022-02-15")
    assert rows(newest, "n") == [(1,), (4,), (7,)]
    assert "PartitionFilters: [isnotnull(d" in plan_of(newest)


def test_partition_names_with_special_characters(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.append_partitioned(spark.createDataFrame([(1, "a/b c+d=é%")], "n int, k string"), path, "k")
    assert [r.value for r in files.listed_partitions(spark, path, "k").collect()] == ["a/b c+d=é%"]
