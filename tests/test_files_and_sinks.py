import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files


def test_delimited_fails_fast(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,n\nx,1\ny,oops\n")
    df = files.read_delimited(spark, str(path), T.StructType.fromDDL("id string, n int"))
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select("n").collect()


def test_headerless_pipe_with_quoted_line_breaks(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text('1|"two\nlines"\n2|plain\n')
    schema = T.StructType.fromDDL("id string, t string")
    df = files.read_delimited(spark, str(path), schema, sep="|", header=False, multi_line=True)
    assert rows(df) == [("1", "two\nlines"), ("2", "plain")]


def test_codes_keep_zeros_and_the_mark_is_skipped(spark, tmp_path, rows):
    path = tmp_path / "bom.csv"
    path.write_text("﻿code,amount\n007,1.5\n", encoding="utf-8")
    df = files.read_text_columns(spark, str(path), types={"amount": "decimal(5,2)"})
    assert df.columns == ["code", "amount"]
    assert df.first()["code"] == "007"


def test_padded_tables(spark, tmp_path, rows):
    path = tmp_path / "padded.csv"
    path.write_text(" id | name |  day \n  1 | ann  | 2020-01-31\n  2 | null | null\n")
    df = files.read_padded(spark, str(path), T.StructType.fromDDL("id int, name string, day date"))
    assert [r["name"] for r in df.orderBy("id").collect()] == ["ann", None]
    assert df.where("day is null").count() == 1


def test_control_count_position_is_one_based(spark, tmp_path):
    path = tmp_path / "t.ctl"
    path.write_text("file.csv|20220101| 42 |x\n")
    assert files.read_control(spark, str(path)).first()["expected"] == 42
    assert files.read_control(spark, str(path), position=2).first()["expected"] == 20220101


def test_records_keep_their_order_within_a_file(spark, tmp_path):
    path = tmp_path / "r.txt"
    path.write_text(";".join(f"r{i}" for i in range(100)))
    got = [r["value"] for r in files.read_records(spark, str(path)).orderBy("file", "offset").collect()]
    assert got == [f"r{i}" for i in range(100)]


def _table(spark, *rows):
    return spark.createDataFrame(list(rows), "id int, day string").withColumn("day", F.to_date("day"))


def test_partition_presence(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31"), (2, "2020-02-29")), path, "day")
    df = files.read_zone(spark, path)
    assert files.partition_exists(df, "day", "2020-01-31")
    assert not files.partition_exists(df, "day", "2020-03-31")
    got = files.partitions_present(df, "day", ["2020-02-29", "2021-01-31"])
    assert [r["present"] for r in got.orderBy("value").collect()] == [True, False]


def test_replace_partition_is_idempotent_and_leaves_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31"), (2, "2020-02-29"), (3, "2020-02-29")), path, "day")
    again = _table(spark, (9, "2020-02-29"))
    for _ in range(2):
        assert sinks.replace_partition(again, path, "day", "2020-02-29") == 1
    assert rows(files.read_zone(spark, path), "id") == [(1,), (9,)]


def test_replace_partition_refuses_other_values_and_keeps_the_old_rows(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31"), (2, "2020-02-29")), path, "day")
    for stray in ("2020-03-31", None):
        mixed = _table(spark, (9, "2020-02-29"), (8, stray))
        with pytest.raises(Exception, match="row outside day=2020-02-29"):
            sinks.replace_partition(mixed, path, "day", "2020-02-29")
    assert rows(files.read_zone(spark, path), "id") == [(1,), (2,)]
    with pytest.raises(ValueError):
        sinks.replace_partition(_table(spark, (1, "2020-01-31")), path, "day", "../x")


def test_replacing_by_nothing_empties_the_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31"), (2, "2020-02-29")), path, "day")
    again = _table(spark, (5, "2020-02-29"))
    known_empty, found_empty = again.where("id < 0"), again.repartition(2).where("hash(id) % 2 = 5")
    assert sinks.replace_partition(found_empty, path, "day", "2020-02-29") == 0
    assert rows(files.read_zone(spark, path), "id") == [(1,)]
    assert sinks.replace_partition(again, path, "day", "2020-02-29") == 1
    assert sinks.replace_partition(known_empty, path, "day", "2020-02-29") == 0
    assert rows(files.read_zone(spark, path), "id") == [(1,)]


def test_create_append_and_overwrite(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    one = _table(spark, (1, "2020-01-31"))
    sinks.create(one, path, "day")
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.create(one, path, "day")
    sinks.append_partitioned(_table(spark, (2, "2020-01-31")), path, "day", files=1)
    assert rows(files.read_zone(spark, path), "id") == [(1,), (2,)]
    sinks.overwrite(one, path, "day")
    assert rows(files.read_zone(spark, path), "id") == [(1,)]


def test_export_names_one_file_or_keeps_the_part_files(spark, tmp_path):
    df = spark.range(100, numPartitions=4)
    single = sinks.export_text(df, str(tmp_path / "a"), "out.txt")
    assert single == ["out.txt"] and "out.txt" in os.listdir(tmp_path / "a")
    many = sinks.export_text(df, str(tmp_path / "b"), None)
    assert len(many) == 4 and set(many) <= set(os.listdir(tmp_path / "b"))
    back = spark.read.csv([str(tmp_path / "b" / n) for n in many], header=True)
    assert back.count() == 100


def test_a_failed_count_keeps_the_new_rows(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31")), path, "day")

    def fail(self):
        raise Py4JJavaError("lost", None)

    monkeypatch.setattr(Py4JJavaError, "__init__", lambda self, *a: Exception.__init__(self, *a))
    monkeypatch.setattr(sinks.Observation, "get", property(fail))
    with pytest.raises(Py4JJavaError):
        sinks.replace_partition(_table(spark, (9, "2020-01-31")), path, "day", "2020-01-31")
    assert rows(files.read_zone(spark, path), "id") == [(9,)]


def test_several_partitions_are_replaced_at_once_in_few_files(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.create(_table(spark, (1, "2020-01-31"), (2, "2020-02-29"), (3, "2020-03-31")), path, "day")
    many = spark.range(1000, numPartitions=400).selectExpr("id", "DATE'2020-02-29' AS day")
    assert sinks.replace_partition(many, path, "day", ["2020-01-31", "2020-02-29"]) == 1000
    assert sorted(d for d in os.listdir(path) if d.startswith("day")) == ["day=2020-02-29", "day=2020-03-31"]
    assert len([f for f in os.listdir(f"{path}/day=2020-02-29") if f.endswith(".parquet")]) < 100


def test_export_keeps_every_value(spark, tmp_path, rows):
    values = [(1, " spaced "), (2, 'a "quoted" word'), (3, "two\nlines"), (4, None), (5, "a|b"), (6, "back\\slash")]
    df = spark.createDataFrame(values, "n int, t string")
    (name,) = sinks.export_text(df, str(tmp_path / "a"), "o.csv", sep="|")
    back = files.read_delimited(
        spark, str(tmp_path / "a" / name), df.schema, sep="|", multi_line=True, escape='"'
    )
    assert rows(back) == sorted(values, key=repr)


def test_export_of_no_rows_is_one_file(spark, tmp_path):
    empty = spark.range(5).where("id % 7 = 6")
    assert sinks.export_text(empty, str(tmp_path / "a"), "o.csv") == ["o.csv"]
    assert spark.read.csv(str(tmp_path / "a" / "o.csv"), header=True).count() == 0


def test_export_with_byte_order_mark(spark, tmp_path):
    sinks.export_text(spark.range(1), str(tmp_path / "a"), "o.csv", byte_order_mark=True)
    assert (tmp_path / "a" / "o.csv").read_bytes().startswith(b"\xef\xbb\xbfid")
