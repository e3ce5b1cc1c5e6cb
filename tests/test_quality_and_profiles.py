from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerloom.operators import profiling, quality
from ledgerloom.sinks import tables as sinks

DAY = date(2022, 1, 31)


def _frame(spark):
    return spark.createDataFrame(
        [(1, "ab", DAY), (2, None, DAY), (3, "abc1", date(2022, 1, 30)), (None, "xyz", DAY)],
        "id int, name string, load_date date",
    )


def _report(df, rules, **kw):
    return {
        (r["rule"], r["target"]): (r["total"], r["passed"], r["pct"], r["status"], r["accepted"])
        for r in quality.evaluate(df, rules, **kw).collect()
    }


def test_row_rules_and_thresholds(spark):
    got = _report(
        _frame(spark),
        [
            quality.NotNull(columns=("id", "name"), min_threshold=50.0, target_threshold=60.0),
            quality.DateEquals(column="load_date", value="2022-01-31 00:00:00", min_threshold=70.0),
            quality.MatchesPattern(column="name", min_threshold=50.0, target_threshold=50.0, acceptance_min=10.0),
            quality.MaxLength(column="name", limit=3),
        ],
    )
    assert got[("NotNull", "id,name")] == (4, 2, Decimal("50.0000"), "WARN", False)
    assert got[("DateEquals", "load_date")] == (4, 3, Decimal("75.0000"), "WARN", False)
    assert got[("MatchesPattern", "name")] == (4, 2, Decimal("50.0000"), "OK", True)
    assert got[("MaxLength", "name")] == (4, 3, Decimal("75.0000"), "KO", False)


def test_percent_is_never_rounded_up_to_full(spark):
    df = spark.range(3_000_000).selectExpr("CASE WHEN id > 0 THEN id END AS id")
    (row,) = quality.evaluate(df, [quality.NotNull(columns=("id",))]).collect()
    assert (row["pct"], row["status"]) == (Decimal("99.9999"), "KO")


def test_count_rules(spark):
    df = _frame(spark)
    control = spark.createDataFrame([(5,)], "expected bigint")
    got = _report(
        df,
        [
            quality.NotEmpty(),
            quality.MatchesControlCount(control=control),
            quality.MatchesDatasetCount(dataset=df),
            quality.MatchesDatasetCount(dataset=df, condition="load_date = DATE'2022-01-31'"),
        ],
        subset="load_date = DATE'2022-01-31'",
    )
    assert got[("NotEmpty", "*")][:4] == (3, 3, Decimal("100.0000"), "OK")
    assert got[("MatchesControlCount", "control")][:4] == (5, 3, Decimal("60.0000"), "KO")
    assert got[("MatchesDatasetCount", "dataset")][2:4] == (Decimal("75.0000"), "KO")
    assert got[("MatchesDatasetCount", "load_date = DATE'2022-01-31'")][2:4] == (Decimal("100.0000"), "OK")


def test_empty_frames(spark):
    empty = _frame(spark).where("id > 100")
    got = _report(empty, [quality.NotEmpty(), quality.NotNull(columns=("id",)),
                          quality.MatchesDatasetCount(dataset=_frame(spark))])
    assert got[("NotEmpty", "*")][3] == "KO"
    assert got[("NotNull", "id")][3] == "OK"
    assert got[("MatchesDatasetCount", "dataset")][:4] == (4, 0, Decimal("0.0000"), "KO")


def test_enforce_stops_only_on_critical_failures(spark):
    df = _frame(spark)
    lenient = quality.evaluate(df, [quality.NotNull(columns=("id",), critical=False)])
    assert quality.enforce(lenient) is lenient
    with pytest.raises(quality.QualityFailure, match=r"NotNull\(id\)"):
        quality.enforce(quality.evaluate(df, [quality.NotNull(columns=("id",))]))


def test_refusals_name_each_failed_rule(spark, rows):
    rules = [quality.NotNull(columns=("id",)), quality.MatchesPattern(column="name"), quality.NotEmpty()]
    got = rows(quality.refusals(_frame(spark), rules), "name", "refused_by")
    assert got == [("abc1", "MatchesPattern(name)"), ("xyz", "NotNull(id)"), (None, "MatchesPattern(name)")]
    assert quality.refusals(_frame(spark), [quality.NotEmpty()]).count() == 0


def test_acceptance(spark, rows):
    df = _frame(spark)
    got = rows(quality.acceptance(df, df.drop("name"), more_columns=True))
    assert got == [("column_count", True), ("not_empty", True), ("same_records", True)]
    got = dict(rows(quality.acceptance(df.limit(1), df.drop("name"))))
    assert got == {"column_count": False, "not_empty": True, "same_records": False}


def test_files_per_directory(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.append_partitioned(_frame(spark), path, "load_date", files=1)
    sinks.append_partitioned(_frame(spark), path, "load_date", files=1)
    got = rows(quality.files_per_directory(spark, path, max_files=2), "directory", "files", "ok")
    assert got == [("load_date=2022-01-30", 2, False), ("load_date=2022-01-31", 2, False)]


def test_format_audit(spark, rows):
    df = spark.createDataFrame(
        [(1, "01/02/2022", None), (2, "1/2/2022", "2022-02-01 00:00:00"), (3, None, "01/02/2022")],
        "n int, a_date string, b_date string",
    )
    assert rows(profiling.format_audit(df, ["a_date", "b_date"])) == [
        ("a_date", 3, 1, 1, 1), ("b_date", 3, 1, 1, 1),
    ]
    assert rows(profiling.off_format_values(df, ["a_date", "b_date"])) == [
        ("a_date", "1/2/2022", 1), ("b_date", "2022-02-01 00:00:00", 1),
    ]
    assert rows(profiling.null_positions(df, ["a_date", "b_date"], "n")) == [("a_date", 3), ("b_date", 1)]


def test_null_audit_reports_absent_columns(spark, rows):
    schema = T.StructType(
        [T.StructField("id", T.IntegerType(), False), T.StructField("gone", T.StringType(), False),
         T.StructField("name", T.StringType())]
    )
    df = _frame(spark)
    assert rows(profiling.null_audit(df, schema)) == [("gone", False, None), ("id", True, 1)]
    assert profiling.required_present(df, schema) == ["gone"]
    assert rows(profiling.null_counts(df)) == [("id", 1), ("load_date", 0), ("name", 1)]
    assert profiling.shape(df) == (4, 3)
    assert profiling.preview(df, 2).count() == 2
    assert rows(profiling.rows_with_null(df, "name"), "id") == [(2,)]


def test_distinct_values(spark, rows):
    df = spark.createDataFrame([("f", "aa"), ("f", "aa"), ("f", "b"), ("g", None)], "field string, bad string")
    assert rows(profiling.distinct_values(df, "field", "bad")) == [
        ("f", "aa", 2, 2), ("f", "b", 1, 1), ("g", None, None, 1),
    ]
    assert rows(profiling.value_digest(df, "field", "bad")) == [("f", 2, 2), ("g", 1, None)]


def test_a_date_rule_takes_dates_only(spark):
    df = spark.createDataFrame([("2022-01-31",)], "d string").selectExpr("CAST(d AS DATE) AS d")
    assert quality.evaluate(df, [quality.DateEquals(column="d", value="2022-01-31T00:00:00")]).first()["status"] == "OK"
    for bad in ("2022-01-31 10:00:00", "31/01/2022", "2022-01-31x"):
        with pytest.raises(ValueError):
            quality.evaluate(df, [quality.DateEquals(column="d", value=bad)])


def test_a_control_input_holds_one_row(spark):
    df = spark.range(3)
    for control in (spark.createDataFrame([(3,), (5,)], "expected bigint"), spark.createDataFrame([], "expected bigint")):
        with pytest.raises(Exception, match="needs one control row"):
            quality.evaluate(df, [quality.MatchesControlCount(control=control)]).collect()
