"""What the physical plans must and must not contain at cluster scale."""

import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import concepts, snapshots, textmatch
from ledgerloom.plans import families
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files
from ledgerloom.sources import movements as read
from ledgerloom.workload.queries import QUERIES
from tests.conftest import plan_of

SF = "/root/testdata/sf0.001"
ODATE = "2022-01-31"


@pytest.fixture
def no_automatic_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def _stored_transfers(spark, tmp_path):
    rows = [
        (str(i), date(2022, 1, 1 + i % 28), date(2022, 1, 31), "MXP", Decimal("1.00"), "A", "CO", str(i), "unused")
        for i in range(50)
    ]
    df = spark.createDataFrame(
        rows,
        "agreement_id string, sit_transaction_date date, load_date date, operation_currency_id string, "
        "total_transaction_amount decimal(17,2), sender_application_id string, operation_status_type string, "
        "dispersal_account_id string, other string",
    )
    path = str(tmp_path / "transfers")
    sinks.append_partitioned(df, path, "load_date")
    return files.read_zone(spark, path)


def test_reader_filters_and_columns_reach_the_scan(spark, tmp_path):
    plan = plan_of(read.transfers(_stored_transfers(spark, tmp_path), ODATE, "2022-02-05"))
    assert "PartitionFilters: [isnotnull(load_date" in plan
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "EqualTo(operation_status_type,CO)" in pushed
    assert "GreaterThanOrEqual(sit_transaction_date" in pushed
    assert "other" not in plan.split("ReadSchema: ")[1].split("\n")[0]


def test_newest_cutoff_prunes_partitions(spark, tmp_path):
    stored = _stored_transfers(spark, tmp_path)
    newest = snapshots.rows_at_newest(stored, "load_date")
    filters = plan_of(newest).split("PartitionFilters: ")[1].split("\n")[0]
    assert "Subquery" in filters
    assert newest.count() == 50


def _concept_plan(spark, tmp_path):
    rates = spark.createDataFrame(
        [("MXP", date(2022, 1, 5), Decimal("1.000000"))],
        "currency_id string, load_date date, exchange_currency_min_amount decimal(17,6)",
    )
    held = spark.createDataFrame(
        [("1", "A", date(2022, 1, 31))], "account_id string, contract_status_type string, cutoff_date date"
    )
    book = spark.createDataFrame(
        [("SITAIMP", "4110", "S", "41", "d")],
        "primary_key_type string, data_code_id string, sender_application_id string, "
        "commercial_product_type string, commercial_subproduct_type string",
    )
    moves = read.transfers(_stored_transfers(spark, tmp_path), ODATE, "2022-02-05")
    out = concepts.concept_rollup([families.sit(moves, rates)], held, book, ODATE)
    return plan_of(out)


def test_movements_are_summed_before_they_meet_the_accounts(spark, tmp_path):
    tree = _concept_plan(spark, tmp_path).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1
    # Small sides are broadcast by their size, and only sums meet the concepts and the accounts.
    assert "HashAggregate" in tree[tree.index("LeftSemi") : tree.index("Scan parquet")]
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree


@pytest.mark.parametrize("name", ["concept_nom", "concept_b40w", "concept_sicoco", "concept_sicoco5", "profit_first_part"])
def test_only_sums_are_dealt_out_by_concept(spark, no_automatic_broadcast, name):
    """However large the catalogue: below each exchange by concept key stands an aggregation, never raw movements."""
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().splitlines()
    dealt = [i for i, line in enumerate(text) if re.search(r"Exchange hashpartitioning\((concept_key|movement_key)#\d+, \d", line)]
    assert dealt
    for i in dealt:
        below = "\n".join(text[i + 1 :]).split("FileScan")[0]
        assert "Aggregate" in below, below


def test_large_lookups_fall_back_to_shuffle_joins(spark, tmp_path, no_automatic_broadcast):
    plan = _concept_plan(spark, tmp_path)
    assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_busy_account_is_split_in_the_general_movement_join(spark, no_automatic_broadcast):
    """One account with a third of the rows: the join reads its partition in parts."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        account = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000)
        moves = spark.range(60_000, numPartitions=8).select(
            F.lit("2022-01-31").cast("date").alias("load_date"),
            F.lit("2022-01-30").cast("date").alias("transaction_date"),
            F.concat(F.lit("movement "), "id").alias("transaction_desc"),
            F.lit("MXP").alias("currency_id"),
            F.lit("K").alias("movement_key"),
            F.lit("").alias("counterpart_id"),
            account.cast("string").alias("folio_contract_id"),
            (F.abs(F.xxhash64("id")) % 10**12).cast("decimal(17,2)").alias("transaction_amount"),
        )
        held = spark.range(1000).select(
            F.col("id").cast("string").alias("account_id"), F.lit("A").alias("contract_status_type"),
            F.lit("2022-01-31").cast("date").alias("cutoff_date"),
            F.lit("p").alias("commercial_product_type"), F.lit("s").alias("commercial_subproduct_type"),
        )
        book = spark.createDataFrame(
            [("K", "7110", "S", "+", "71", "d")],
            "primary_key_type string, data_code_id string, sender_application_id string, sign_type string, "
            "commercial_product_type string, commercial_subproduct_type string",
        )
        out = concepts.signed_movements(moves, held, book, ODATE)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_copies_of_a_text_are_dropped_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    tree = plan_of(textmatch.dedupe_by_text(df, "t", "n")).split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    assert tree.rindex("WindowGroupLimit") > tree.index("Exchange")


def test_top_matches_keep_few_rows_per_task(spark):
    df = spark.createDataFrame([(1, "a")], "n int, t string")
    plan = plan_of(textmatch.closest(df, "t", "q", 3, ["n"]))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    each = plan_of(textmatch.closest_each(df, "t", ["q", "r"], 3, ["n"])).split("\n\n")[0]
    assert each.count("WindowGroupLimit") == 2


def test_newest_versions_use_no_window(spark):
    df = spark.createDataFrame([("a", date(2022, 1, 1))], "k string, d date")
    plan = plan_of(snapshots.newest_versions(df, ["k"], "d"))
    assert "Window" not in plan and "partial_max" in plan
