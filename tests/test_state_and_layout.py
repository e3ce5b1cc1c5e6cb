"""Kept sums and counters equal a run from scratch; accounts stored by account; the shared scratch folder."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import profiling, quality, snapshots
from ledgerloom.plans import restate
from ledgerloom.session import shared_folder
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources.files import path_exists
from ledgerloom.workload.queries import QUERIES, _sources, _with_stored_accounts
from ledgerloom.workload.roles import DATEM, ODATE

SF = "/root/testdata/sf0.001"


# --- restating -------------------------------------------------------------------


def _facts(spark, tables, path, datem):
    specs = [family for _, family in restate.late_sources(tables, ODATE, datem)]
    catalogue = snapshots.current_catalogue(tables["catalogue"])
    return restate.restated_facts(spark, path, tables["accounts"], catalogue, ODATE, datem, specs)


def test_deliveries_add_up_and_run_again(spark, rows, tmp_path):
    tables, path, whole = _sources(spark, SF), str(tmp_path / "parts"), str(tmp_path / "whole")
    restate.keep_delivery(tables, whole, ODATE, DATEM)
    days = ["1998-03-20", "1998-04-01", DATEM]
    for after, datem in zip([None, *days], days):
        first = restate.keep_delivery(tables, path, ODATE, datem, after=after)
        assert restate.keep_delivery(tables, path, ODATE, datem, after=after) == first
    want = rows(_facts(spark, tables, whole, DATEM))
    assert want and rows(_facts(spark, tables, path, DATEM)) == want
    # An earlier bound leaves later deliveries out.
    early = str(tmp_path / "early")
    restate.keep_delivery(tables, early, ODATE, "1998-04-01")
    assert rows(_facts(spark, tables, path, "1998-04-01")) == rows(_facts(spark, tables, early, "1998-04-01"))


def test_a_delivery_reads_late_rows_only(spark):
    moves = spark.createDataFrame([(date(2022, 1, 30), 1), (date(2022, 2, 1), 2), (None, 3)], "load_date date, n int")
    tables = {"transfers": moves, "accounts": moves}
    late = restate.arrived_after(tables, "2022-01-31")
    assert [r.n for r in late["transfers"].collect()] == [2] and late["accounts"] is moves
    assert restate.arrived_after(tables, None)["transfers"] is moves


# --- quality counters ------------------------------------------------------------


def _rules(pattern="^[a-z]+$"):
    return [
        quality.NotEmpty(),
        quality.NotNull(columns=("k",), min_threshold=20.0, target_threshold=60.0),
        quality.MatchesPattern(column="k", pattern=pattern),
        quality.MaxLength(column="k", limit=2, critical=False),
    ]


def _table(spark, path, *parts):
    for p, values in parts:
        df = spark.createDataFrame([(v, p) for v in values], "k string, p string")
        sinks.append_partitioned(df, path, "p")


def test_counters_add_up_to_the_report(spark, rows, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    _table(spark, path, ("a", ["x", None, "long", "9"]), (None, ["y", None]))
    assert quality.update_counters(spark, path, "p", _rules(), state) == ["a", None]
    assert quality.update_counters(spark, path, "p", _rules(), state) == []
    _table(spark, path, ("b c", ["zz"] * 5 + [None]))
    assert quality.update_counters(spark, path, "p", _rules(), state) == ["b c"]
    report = quality.evaluate_state(spark.read.parquet(state), _rules())
    assert rows(report) == rows(quality.evaluate(spark.read.parquet(path), _rules()))


def test_only_new_partitions_are_scanned(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    _table(spark, path, ("a", ["x"]))
    quality.update_counters(spark, path, "p", _rules(), state)
    before = spark.read.parquet(state).collect()
    # Were the counted partition opened again, its broken file would fail the job.
    broken = next((tmp_path / "t" / "p=a").glob("*.parquet"))
    broken.write_bytes(b"no parquet file")
    for crc in (tmp_path / "t" / "p=a").glob(".*.crc"):
        crc.write_bytes(b"")
    schema = spark.createDataFrame([], "k string, p string").schema
    sinks.append_partitioned(spark.createDataFrame([("y", "b")], schema), path, "p")
    wanted = spark.read.schema(schema).parquet(path).where("p = 'b'")
    counted = quality.partition_counters(wanted, _rules(), "p")
    assert [r.partition for r in counted.collect()] == ["b"]
    assert quality.unseen_partitions(spark, path, "p", spark.createDataFrame(before)) == ["b"]


def test_counters_of_other_rules_are_refused_and_partitions_forgotten(spark, rows, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    _table(spark, path, ("a", ["x", "y"]), ("b", ["z"]))
    quality.update_counters(spark, path, "p", _rules(), state)
    with pytest.raises(Exception, match="the state counts other rules"):
        quality.evaluate_state(spark.read.parquet(state), _rules("^x$")).collect()
    # Thresholds are no part of what is counted.
    looser = [quality.NotEmpty(), quality.NotNull(columns=("k",)), *_rules()[2:]]
    assert quality.evaluate_state(spark.read.parquet(state), looser).count() == 4
    fewer = str(tmp_path / "fewer")
    quality.forget_partitions(spark, state, ["a"], fewer)
    assert rows(spark.read.parquet(fewer), "partition") == [("b",)]
    assert quality.update_counters(spark, path, "p", _rules(), fewer) == ["a"]


def test_report_of_an_empty_state(spark, rows, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "state")
    _table(spark, path, ("a", ["x"]))
    quality.update_counters(spark, path, "p", _rules(), state)
    empty = spark.read.parquet(state).where("partition = 'none'")
    assert rows(quality.evaluate_state(empty, _rules())) == rows(quality.evaluate(spark.read.parquet(path).where("false"), _rules()))


# --- stored accounts and scratch -------------------------------------------------


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_stored_accounts_are_joined_without_an_exchange(spark, rows):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        tables = _sources(spark, SF)
        stored = _with_stored_accounts(spark, tables)["accounts"]
        copies = snapshots.open_account_copies(stored, ODATE)
        assert _exchanges(copies) == 0 and _exchanges(snapshots.open_account_copies(tables["accounts"], ODATE)) > 0
        assert rows(copies) == rows(snapshots.open_account_copies(tables["accounts"], ODATE))
        sums = spark.createDataFrame([("0000000001", Decimal("1.00"))], "account_key string, amount decimal(17,2)")
        joined = sums.groupBy("account_key").agg(F.sum("amount")).join(copies, F.col("account_key") == F.col("account_id"))
        assert _exchanges(joined) == 1
        assert _exchanges(QUERIES["concept_all_staged"](spark, SF)) < _exchanges(QUERIES["concept_all"](spark, SF))
    finally:
        spark.conf.set(name, before)


def test_scratch_is_never_a_folder_of_one_machine():
    with pytest.raises(ValueError, match="one machine"):
        shared_folder("yarn", None, "file:/home/me/spark-warehouse")
    with pytest.raises(ValueError, match="one machine"):
        shared_folder("spark://host:7077", None, "/home/me/spark-warehouse")
    with pytest.raises(ValueError, match="one machine"):
        shared_folder("local-cluster[2,1,1024]", None, "file:/tmp/w")
    assert shared_folder("yarn", None, "hdfs://name/warehouse") == "hdfs://name/warehouse"
    assert shared_folder("yarn", "/mnt/shared", "file:/w") == "/mnt/shared"
    assert shared_folder("local[4]", None, "file:/w") == shared_folder("local", "", "file:/w") == "file:/w"


def test_preview_in_an_order(spark):
    df = spark.range(100)
    assert [r.id for r in profiling.preview(df.withColumn("n", -F.col("id")), 3, ["n"]).collect()] == [99, 98, 97]
    assert profiling.preview(df, 2).count() == 2


def test_paths_are_found(spark, tmp_path):
    assert path_exists(spark, str(tmp_path)) and not path_exists(spark, str(tmp_path / "none"))
