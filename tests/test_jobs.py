import json

import pytest

from ledgerloom.operators import quality
from ledgerloom.plans import ingest, jobs
from ledgerloom.sources import files
from ledgerloom.workload.queries import QUERIES
from ledgerloom.workload.roles import DATEM, ODATE, role

SF = "/root/testdata/sf0.001"
FIELDS = [
    ("visit_id", "int32", "NUMERIC LARGE", False, None),
    ("visit_name", ["string", "null"], "ALPHANUMERIC(10)", False, None),
    ("visit_start_date", ["date", "null"], "DATE", False, "dd/MM/yyyy"),
    ("paid_amount", ["null", "decimal(17,2)"], "DECIMAL(17,2)", False, None),
    ("load_date", "date", "DATE", True, "yyyy-MM-dd"),
]


@pytest.fixture
def schema_file(tmp_path):
    fields = []
    for name, kind, logical, injected, fmt in FIELDS:
        fields.append({"name": name, "type": kind, "logicalFormat": logical, "metadata": injected})
        if fmt:
            fields[-1]["format"] = fmt
    path = tmp_path / "visits.schema"
    path.write_text(json.dumps({"name": "visits", "fields": fields}))
    return str(path)


def test_landing_to_raw_to_master(spark, tmp_path, schema_file, rows):
    raw, master = str(tmp_path / "raw"), str(tmp_path / "master")
    for day, text in (
        ("2022-01-30", '1| ann |01/01/2022|1.50\n'),
        ("2022-01-31", '2|"two\nlines"|31/01/2022| 2.5\n3|||\n'),
        ("2022-01-31", '2|"two\nlines"|31/01/2022| 2.5\n4|||\n'),
    ):
        landing = tmp_path / f"visits-{day}.csv"
        landing.write_text(text)
        jobs.landing_job(
            spark, str(landing), raw, schema_file, {"load_date": day}, "load_date",
            sep="|", header=False, multi_line=True,
        )
        jobs.master_job(spark, raw, master, schema_file, schema_file, "load_date", day)
    stored = files.read_zone(spark, master)
    assert rows(stored, "visit_id", "visit_name") == [(1, "ann"), (2, "twolines"), (4, None)]
    assert dict(stored.dtypes)["paid_amount"] == "decimal(17,2)"
    raw_rows = files.read_zone(spark, raw).where("load_date = '2022-01-31'")
    rules = [
        quality.MatchesDatasetCount(dataset=raw_rows),
        quality.NotNull(columns=("visit_id", "load_date")),
        quality.DateEquals(column="load_date", value="2022-01-31"),
    ]
    report = jobs.quality_job(stored, rules, str(tmp_path / "dq"), "load_date = DATE'2022-01-31'")
    assert {r["status"] for r in report.collect()} == {"OK"}
    with pytest.raises(quality.QualityFailure):
        jobs.quality_job(stored, [quality.NotNull(columns=("visit_name",))], str(tmp_path / "dq"))
    assert files.read_zone(spark, str(tmp_path / "dq")).count() == 1
    asked = [quality.NotNull(columns=("visit_name",), with_refusals=True, critical=False), quality.NotNull(columns=("paid_amount",), critical=False)]
    jobs.quality_job(stored, asked, str(tmp_path / "dq"), refused=str(tmp_path / "refused"))
    refused = files.read_zone(spark, str(tmp_path / "refused"))
    assert rows(refused, "visit_id", "refused_by") == [(4, "NotNull(visit_name)")]
    with pytest.raises(ValueError, match="refusals"):
        jobs.quality_job(stored, asked, str(tmp_path / "dq"))


def test_file_counts_of_the_table_jobs(spark, tmp_path, schema_file):
    raw, master = str(tmp_path / "raw"), str(tmp_path / "master")
    (tmp_path / "v.csv").write_text("".join(f"{i}|n|01/01/2022|1.5\n" for i in range(50)))
    jobs.landing_job(
        spark, str(tmp_path / "v.csv"), raw, schema_file, {"load_date": "2022-01-30"}, "load_date",
        sep="|", header=False, files_count=3,
    )
    jobs.master_job(spark, raw, master, schema_file, schema_file, "load_date", "2022-01-30", files_count=2)
    for path, count in ((raw, 3), (master, 2)):
        found = quality.files_per_directory(spark, path).collect()
        assert [r["files"] for r in found] == [count]


def test_both_profit_parts_from_stored_tables(spark, tmp_path, rows):
    names = {*jobs.FIRST_PART_TABLES, *jobs.SECOND_PART_TABLES}
    paths = {n: str(tmp_path / n) for n in names}
    for name, path in paths.items():
        frame = role(spark, SF, "cheques" if name == "deposits" else name)
        if name == "earlier_facts":
            frame = frame.where(f"cutoff_date = DATE'{ODATE}'")
        frame.write.parquet(path)
    first, target = str(tmp_path / "first"), str(tmp_path / "facts")
    jobs.first_part_job(spark, paths, ODATE, first)
    for _ in range(2):
        written = jobs.second_part_job(spark, paths, ODATE, DATEM, first, target)
    facts = files.read_zone(spark, target)
    want = QUERIES["concept_all"](spark, SF).where(f"cutoff_date = DATE'{ODATE}'")
    assert written == want.count() == facts.count()
    assert facts.select(want.columns).exceptAll(want).isEmpty()
    with pytest.raises(KeyError, match="no path for rates"):
        jobs.load_tables(spark, {"accounts": paths["accounts"]}, ("accounts", "rates"))


def test_balance_export(spark, tmp_path):
    balances, branches = str(tmp_path / "balances"), str(tmp_path / "branches")
    role(spark, SF, "balances").write.parquet(balances)
    role(spark, SF, "branches").write.parquet(branches)
    day = role(spark, SF, "balances").selectExpr("max(CAST(gl_date AS STRING))").first()[0]
    out = str(tmp_path / "out")
    names = jobs.balance_export_job(spark, balances, branches, day, ODATE, out, "balances.txt")
    assert names == ["balances.txt"]
    back = spark.read.csv(f"{out}/balances.txt", header=True)
    assert back.columns == ingest.BALANCE_COLUMNS
