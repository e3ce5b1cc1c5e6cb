import json
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from ledgerloom import schemas

RECORD = {
    "name": "visits",
    "partitions": ["cutoff_date"],
    "fields": [
        {"name": "visit_id", "type": "string", "logicalFormat": "ALPHANUMERIC(10)", "metadata": False},
        {"name": "seen_date", "type": ["date", "null"], "logicalFormat": "DATE", "format": "dd/MM/yyyy", "metadata": False},
        {"name": "cars_number", "type": ["null", "int32"], "logicalFormat": "NUMERIC SHORT", "metadata": False},
        {"name": "paid_amount", "type": ["null", "decimal(21,10)"], "logicalFormat": "DECIMAL(21,10)", "metadata": False},
        {"name": "cutoff_date", "type": "date", "logicalFormat": "DATE", "format": "yyyy-MM-dd", "metadata": True},
    ],
}


def test_typed_and_raw_schema(tmp_path):
    path = tmp_path / "visits.schema"
    path.write_text("﻿" + json.dumps(RECORD), encoding="utf-8")
    typed = schemas.read_table_schema(path)
    assert [f.dataType.simpleString() for f in typed] == [
        "string", "date", "int", "decimal(21,10)", "date",
    ]
    assert [f.nullable for f in typed] == [False, True, True, True, False]
    raw = schemas.read_table_schema(path, raw=True)
    assert {f.dataType.simpleString() for f in raw} == {"string"}
    assert schemas.required_columns(typed) == ["visit_id", "cutoff_date"]
    assert schemas.injected_columns(raw) == ["cutoff_date"]
    assert schemas.columns_of_format(raw, "DATE") == ["seen_date", "cutoff_date"]
    assert schemas.landing_schema(raw).names == ["visit_id", "seen_date", "cars_number", "paid_amount"]
    assert schemas.max_lengths(raw) == {"visit_id": 10}


def test_spark_json_schema(tmp_path):
    wanted = T.StructType.fromDDL("a string, b decimal(37,2), c date, d int")
    path = tmp_path / "s.json"
    path.write_text(wanted.json())
    assert schemas.read_spark_schema(path) == wanted


def test_with_overrides():
    base = T.StructType.fromDDL("a int, b int")
    assert schemas.with_overrides(base, {"a": "string"}).simpleString() == "struct<a:string,b:int>"


def test_conform_reports_every_violation_at_once(spark):
    schema = T.StructType(
        [
            T.StructField("a", T.StringType(), False),
            T.StructField("b", T.IntegerType()),
            T.StructField("c", T.DateType()),
        ]
    )
    df = spark.createDataFrame([(None, "1", 2)], "a string, b string, extra int")
    with pytest.raises(schemas.SchemaMismatch) as error:
        schemas.conform(df, schema)
    message = str(error.value)
    for part in ("missing column c", "unexpected column extra", "column b is string", "column a has 1 null"):
        assert part in message


def test_conform_orders_columns_and_guards_nulls_in_the_plan(spark):
    schema = T.StructType([T.StructField("a", T.StringType(), False), T.StructField("b", T.IntegerType())])
    good = spark.createDataFrame([(1, "x")], "b int, a string")
    assert schemas.conform(good, schema).columns == ["a", "b"]
    bad = spark.createDataFrame([(1, None)], "b int, a string")
    lazy = schemas.conform(bad, schema, check_nulls=False)
    with pytest.raises(Exception, match="must not be null"):
        lazy.collect()


def test_as_fact_widths(spark):
    df = spark.sql(
        "SELECT 'x' AS account_id, '1' AS analytic_concept_id, 's' AS sender_application_id, 'p' AS "
        "commercial_product_type, 'q' AS commercial_subproduct_type, CAST('1.005' AS DECIMAL(20,3)) AS "
        "analytic_concept_amount, DATE'2020-01-31' AS cutoff_date, 1 AS more"
    )
    out = schemas.as_fact(df)
    assert out.schema.simpleString() == schemas.FACT_SCHEMA.simpleString()
    assert out.first()["analytic_concept_amount"] == Decimal("1.01")
