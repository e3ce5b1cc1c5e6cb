from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.operators import lookups, transforms
from ledgerloom.plans import ingest
from ledgerloom.schemas import SchemaMismatch, landing_schema, read_table_schema
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files

VISITS = {
    "fields": [
        {"name": "visit_id", "type": "string", "logicalFormat": "ALPHANUMERIC(10)"},
        {"name": "seen_date", "type": ["date", "null"], "logicalFormat": "DATE", "format": "dd/MM/yyyy"},
        {"name": "cars_number", "type": ["null", "int32"], "logicalFormat": "NUMERIC SHORT"},
        {"name": "paid_amount", "type": ["null", "decimal(21,10)"], "logicalFormat": "DECIMAL(21,10)"},
        {"name": "cutoff_date", "type": "date", "logicalFormat": "DATE", "format": "yyyy-MM-dd", "metadata": True},
    ]
}


def test_column_choice(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a_amount int, amount int, b_date int")
    assert transforms.columns_matching(df, "a_amount|b_date") == ["a_amount", "b_date"]
    assert transforms.columns_matching(df, "amount") == ["amount"]
    assert transforms.columns_containing(df, "amount") == ["a_amount", "amount"]


def test_strict_and_lenient_conversions(spark):
    df = spark.createDataFrame([("1/2/2022", "x")], "d string, n string")
    lenient = transforms.parse_dates("d", "dd/MM/yyyy", strict=False)(df)
    assert lenient.first()["d"] is None
    for step in (transforms.parse_dates("d", "dd/MM/yyyy"), transforms.cast_columns("n", "int32")):
        with pytest.raises(Exception):
            step(df).collect()


def test_dates_in_several_formats_and_languages(spark):
    df = spark.createDataFrame([("05/03/2022",), ("2022-03-05",), ("05 de marzo de 2022",), ("5 March",), ("a,b",), (None,)], "d string")
    formats = ["dd/MM/yyyy", "yyyy-MM-dd", "dd 'de' MMMM 'de' yyyy"]
    read = [r.d for r in transforms.parse_dates("d", formats, strict=False, locale="es-MX")(df).collect()]
    assert read == [date(2022, 3, 5)] * 3 + [None] * 3
    read = [r.d for r in transforms.parse_dates("d", formats[:2], strict=False)(df).collect()]
    assert read == [date(2022, 3, 5)] * 2 + [None] * 4
    fits = df.where("d like '%2022%' or d is null")
    assert transforms.parse_dates("d", formats, locale="es-MX")(fits).where("d is null").count() == 1
    for chosen in (formats, formats[:1]):
        with pytest.raises(Exception):
            transforms.parse_dates("d", chosen, locale="es-MX")(df).collect()


def test_chain(spark):
    df = spark.createDataFrame([(" 1,5 ", "a\nb", "x" * 30, None)], "t_amount string, t string, name string, gap string")
    out = transforms.pipeline(
        df,
        transforms.trim_columns(),
        transforms.replace_text(".*", {r"\n": ""}),
        transforms.decimal_comma_to_point(),
        transforms.truncate("name", 25),
        transforms.fill_nulls({"gap": "none"}),
        transforms.literal("load_date", "2022-01-31"),
        transforms.sql_filter("load_date = '2022-01-31'"),
        transforms.select_columns("t_amount", "t", "name", "gap"),
        transforms.rename_in_order(["amount", "text", "person", "filled"]),
    )
    assert tuple(out.first()) == ("1.5", "ab", "x" * 25, "none")
    with pytest.raises(ValueError):
        transforms.rename_in_order(["one"])(df)
    assert transforms.trim_columns("t", "left")(df).columns == df.columns


def test_landing_to_master(spark, tmp_path, rows):
    raw_schema = read_table_schema(VISITS, raw=True)
    path = tmp_path / "landing.csv"
    path.write_text("visit_id,seen_date,cars_number,paid_amount\n v1 ,31/01/2022, 4,1.5\nv2,,,\n")
    landing = files.read_delimited(spark, str(path), landing_schema(raw_schema))
    raw = ingest.landing_to_raw(landing, {"cutoff_date": "2022-01-31"}, raw_schema)
    assert raw.columns == raw_schema.names
    assert {f.dataType.simpleString() for f in raw.schema} == {"string"}
    formats = ingest.declared_date_formats(raw_schema)
    assert formats == {"seen_date": "dd/MM/yyyy"}
    master = ingest.raw_to_master(
        raw, read_table_schema(VISITS), keep="cutoff_date = '2022-01-31'", date_formats=formats
    )
    assert rows(master) == [
        ("v1", date(2022, 1, 31), 4, Decimal("1.5000000000"), date(2022, 1, 31)),
        ("v2", None, None, None, date(2022, 1, 31)),
    ]
    out = str(tmp_path / "master")
    for _ in range(2):
        sinks.replace_partition(master, out, "cutoff_date", "2022-01-31")
    assert files.read_zone(spark, out).count() == 2


def test_landing_with_a_missing_column_is_refused(spark):
    raw_schema = read_table_schema(VISITS, raw=True)
    df = spark.createDataFrame([("v",)], "visit_id string")
    with pytest.raises(SchemaMismatch, match="missing column seen_date"):
        ingest.landing_to_raw(df, {"cutoff_date": "2022-01-31"}, raw_schema)


def test_bad_values_fail_the_master_job(spark):
    raw = spark.createDataFrame(
        [("v", "31/01/2022", "four", "1", "2022-01-31")],
        "visit_id string, seen_date string, cars_number string, paid_amount string, cutoff_date string",
    )
    master = ingest.raw_to_master(raw, read_table_schema(VISITS), date_formats={"seen_date": "dd/MM/yyyy"})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        master.collect()


def test_declared_join_filters_the_right_side_first(spark, rows):
    left = spark.createDataFrame([("b1", 1), ("b2", 2), (None, 3)], "branch string, n int")
    right = spark.createDataFrame([("b1", "9047"), ("b1", "1000"), ("b2", "1000")], "id string, kind string")
    out = lookups.join_filtered(left, right, {"branch": "id"}, right_filter="kind = '9047'")
    assert rows(out) == [("b1", 1)]
