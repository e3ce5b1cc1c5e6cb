"""Every registered query against its SQL on the smallest test tables."""

import decimal
import importlib
import os

import pytest

from ledgerloom.workload.oracles import ORACLES
from ledgerloom.workload.queries import QUERIES
from tests.conftest import plan_of

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
entry_module = importlib.import_module("__spark_entry__")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for file in sorted(os.listdir(SF)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{file}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize() + 0) if value else "0"
    return repr(value)


def _sorted(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", ["concept_all", "balance_export", "concept_sit"])
def test_building_a_query_starts_no_job(spark, name):
    QUERIES[name](spark, SF)  # the schemas of the test tables are read once
    context = spark.sparkContext
    context.setJobGroup(f"build-{name}", name)
    try:
        QUERIES[name](spark, SF)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup(f"build-{name}")


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, database, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "Pandas"):
        assert unwanted not in plan
    result = database.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert _sorted(df.columns, df.collect()) == _sorted(columns, result.fetchall())
