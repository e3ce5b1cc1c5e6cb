from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, keys, text


def test_month_bounds_of_a_leap_february():
    assert dates.month_start("2024-02-17") == "2024-02-01"
    assert dates.month_end("2024-02-17") == "2024-02-29"
    assert dates.month_end("2023-12-31") == "2023-12-31"


def test_date_columns(spark):
    df = spark.sql("SELECT DATE'2021-02-10' AS d")
    got = df.select(
        dates.month_start_col("d"), dates.month_end_col("d"), dates.date_text("d", "yyyyMMdd")
    ).first()
    assert tuple(got) == (date(2021, 2, 1), date(2021, 2, 28), "20210210")


@pytest.mark.parametrize(
    "given, expected",
    [
        ("0123456789", "0123456789"),
        ("12", "0000000012"),
        (" 12 ", "0000000012"),
        ("12.7", "0000000012"),
        ("abcdefghij", "abcdefghij"),
        ("abc", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_padded_account(spark, given, expected):
    df = spark.createDataFrame([(given,)], "a string")
    assert df.select(keys.padded_account("a")).first()[0] == expected


@pytest.mark.parametrize(
    "code, currency",
    [
        ("19", "MXP"),
        ("20", "USD"),
        ("28", "USD"),
        ("29", "MXP"),
        ("70", "USD"),
        ("79", "MXP"),
        ("abc", "MXP"),
        (None, "MXP"),
    ],
)
def test_currency_from_code(spark, code, currency):
    df = spark.createDataFrame([(code,)], "c string")
    assert df.select(keys.currency_from_code("c")).first()[0] == currency


def test_two_digit_prefixes_every_other_length(spark, rows):
    df = spark.createDataFrame([("1",), ("12",), ("123",), (None,)], "c string")
    assert rows(df.select(keys.two_digit("c"))) == [("01",), ("0123",), ("12",), (None,)]


def test_signs_and_null_conditions(spark):
    df = spark.createDataFrame(
        [("00", Decimal("1.50")), ("07", Decimal("1.50")), (None, Decimal("1.50"))],
        "r string, a decimal(17,2)",
    )
    kept = [r[0] for r in df.select(keys.flipped_unless(F.col("r") == "00", "a")).collect()]
    flipped = [r[0] for r in df.select(keys.flipped_if(F.col("r") == "00", "a")).collect()]
    assert kept == [Decimal("1.50"), Decimal("-1.50"), Decimal("-1.50")]
    assert flipped == [Decimal("-1.50"), Decimal("1.50"), Decimal("1.50")]


def test_money_rounds_half_away_from_zero(spark):
    df = spark.sql("SELECT CAST('2.345' AS DECIMAL(10,3)) AS a, CAST('-2.345' AS DECIMAL(10,3)) AS b")
    assert tuple(df.select(keys.money("a"), keys.money("b")).first()) == (
        Decimal("2.35"),
        Decimal("-2.35"),
    )


def test_joined_key_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(keys.joined_key(F.lit("K"), "x", "y")).first()[0] is None


@pytest.mark.parametrize("given", ["  A b\n", " X ", "\x1cq\x1f", "plain", "", " \t\n", "a\n\nb"])
def test_normalised_equals_python_strip_and_lower(spark, given):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(text.normalised("t")).first()[0] == given.lower().strip()


def test_edit_similarity(spark):
    df = spark.createDataFrame([("kitten",), ("",)], "t string")
    got = [r[0] for r in df.select(text.edit_similarity("t", "sitting")).collect()]
    assert got == [1.0 - 3 / 7, 0.0]
    assert df.where("t = ''").select(text.edit_similarity("t", "")).first()[0] == 1.0
