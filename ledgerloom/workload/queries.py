"""Registered queries: every operator applied to whole test tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates, keys
from ledgerloom.operators import (
    concepts,
    customers,
    lookups,
    profiling,
    quality,
    snapshots,
    textindex,
    textmatch,
    transforms,
)
from ledgerloom.plans import families, ingest, profit, restate
from ledgerloom.schemas import conform, read_spark_schema, read_table_schema
from ledgerloom.session import scratch_path
from ledgerloom.sinks import tables as sinks
from ledgerloom.sources import files, positions
from ledgerloom.sources import movements as read
from ledgerloom.workload.roles import DATEM, ODATE, role, roles, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_DELIVERY = "1998-04-01"
QUESTION = "Which eneren ther one inond whether thatin the best estion for each ander"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.current_catalogue(role(spark, sf, "catalogue"))


def _open(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.open_accounts(role(spark, sf, "accounts"), ODATE)


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return read.daily_rates(role(spark, sf, "rates"), ODATE)


# --- snapshots and dates ---------------------------------------------------


@query
def latest_snapshot(spark, sf):
    return snapshots.newest_versions(role(spark, sf, "accounts"), ["account_id"], "cutoff_date", ODATE)


@query
def latest_snapshot_open_accounts(spark, sf):
    return _open(spark, sf)


@query
def open_account_versions(spark, sf):
    return snapshots.open_account_copies(role(spark, sf, "accounts"), ODATE)


@query
def newest_issuances(spark, sf):
    rows = read.debit_issuances(role(spark, sf, "issuances"), ODATE)
    return snapshots.newest_versions(rows, ["issuing_id"], "load_date")


@query
def month_bounds(spark, sf):
    day = F.to_date("o_orderdate")
    return (
        table(spark, sf, "orders")
        .select(
            dates.month_start_col(day).alias("month_start"),
            dates.month_end_col(day).alias("month_end"),
            dates.date_text(day, "dd/MM/yyyy").alias("day_text"),
        )
        .groupBy("month_start", "month_end", "day_text")
        .agg(F.count("*").alias("n"))
    )


@query
def max_date_as_of(spark, sf):
    return snapshots.newest_date(role(spark, sf, "transfers"), "load_date", ODATE)


def _order_catalogue(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("primary_key_type"),
        F.substring("o_orderpriority", 1, 1).alias("bg_operation_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("data_code_id"),
        F.trunc("o_orderdate", "year").alias("cutoff_date"),
    )


@query
def catalog_newest_cutoff(spark, sf):
    """Orders as catalogue rows: the newest order date, coded rows, one priority."""
    current = snapshots.coded_concepts(snapshots.current_catalogue(_order_catalogue(spark, sf)))
    return snapshots.catalogue_of(current, "1")


def _partitioned(spark: SparkSession, rows: DataFrame, column: str) -> str:
    path = scratch_path(spark, "partitioned")
    sinks.append_partitioned(rows, path, column)
    return path


@query
def max_date_from_partitions(spark, sf):
    """Transfers partitioned by the first day of their load month."""
    months = role(spark, sf, "transfers").select("agreement_id", F.trunc("load_date", "month").alias("load_date"))
    return snapshots.newest_partition(spark, _partitioned(spark, months, "load_date"), "load_date", ODATE)


@query
def catalogue_from_newest_partition(spark, sf):
    path = _partitioned(spark, _order_catalogue(spark, sf), "cutoff_date")
    current = snapshots.rows_at_newest_partition(spark, path, "cutoff_date")
    return snapshots.catalogue_of(snapshots.coded_concepts(current), "1")


# --- readers ---------------------------------------------------------------


@query
def month_window_late_arrivals(spark, sf):
    return read.transfers(role(spark, sf, "transfers"), ODATE, DATEM)


@query
def collections_reader(spark, sf):
    return read.collections_by_agreement(role(spark, sf, "collections"), ODATE, DATEM)


@query
def signed_amount_currency_case(spark, sf):
    return read.cheques(role(spark, sf, "cheques"), ODATE, DATEM)


@query
def deposits_recoded(spark, sf):
    return read.cheque_deposits(role(spark, sf, "cheques"), ODATE, DATEM)


@query
def dispersals_reader(spark, sf):
    return read.dispersals(role(spark, sf, "dispersals"), ODATE)


@query
def debit_movements_reader(spark, sf):
    return read.debit_movements(role(spark, sf, "debits"), ODATE)


@query
def host_to_host_reader(spark, sf):
    return read.host_to_host(role(spark, sf, "host_to_host"), ODATE)


@query
def payrolls_reader(spark, sf):
    return read.payrolls(role(spark, sf, "payrolls"), ODATE)


@query
def general_movements_reader(spark, sf):
    return read.general_movements(role(spark, sf, "general_movements"), ODATE)


@query
def commissions_reader(spark, sf):
    return read.commissions(role(spark, sf, "commissions"), ODATE)


@query
def branch_commissions_reader(spark, sf):
    return read.branch_commissions(role(spark, sf, "branch_commissions"), ODATE)


@query
def composed_key(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        keys.joined_key("l_returnflag", "l_linestatus").alias("plain"),
        keys.joined_key(
            F.lit("K"), F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
        ).alias("nullable"),
        F.substring(F.lpad(F.col("l_partkey").cast("string"), 6, "0"), 3, 4).alias("middle"),
        F.substring(F.col("l_suppkey").cast("string"), -4, 4).alias("ending"),
        F.trim(F.concat(F.lit("  "), "l_linestatus", F.lit(" "))).alias("trimmed"),
    )


# --- joins -----------------------------------------------------------------


@query
def movement_account_join(spark, sf):
    moves = read.transfers(role(spark, sf, "transfers"), ODATE, DATEM)
    return snapshots.join_accounts(moves, _open(spark, sf), F.col("dispersal_account_id"))


@query
def account_join_semi(spark, sf):
    moves = read.transfers(role(spark, sf, "transfers"), ODATE, DATEM)
    return snapshots.join_accounts(
        moves, _open(spark, sf), F.col("dispersal_account_id"), how="left_semi"
    )


@query
def concatenated_key_join(spark, sf):
    moves = read.general_movements(role(spark, sf, "general_movements"), ODATE)
    key = keys.joined_key("counterpart_id", "folio_contract_id")
    return snapshots.join_accounts(moves, _open(spark, sf), key)


@query
def substring_key_join(spark, sf):
    moves = read.commissions(role(spark, sf, "commissions"), ODATE)
    return snapshots.join_accounts(moves, _open(spark, sf), F.col("commission_account_id"))


@query
def padded_key_join(spark, sf):
    moves = read.branch_commissions(role(spark, sf, "branch_commissions"), ODATE)
    return snapshots.join_accounts(
        moves, _open(spark, sf), keys.padded_account("commission_account_id")
    )


@query
def trimmed_key_join(spark, sf):
    moves = read.cheques(role(spark, sf, "cheques"), ODATE, DATEM)
    return snapshots.join_accounts(
        moves, _open(spark, sf), F.trim("credit_internal_account_id")
    )


@query
def fx_lookup_daily(spark, sf):
    moves = read.collections_by_agreement(role(spark, sf, "collections"), ODATE, DATEM)
    return lookups.convert_currency(
        moves, _rates(spark, sf), "currency_id", "transaction_date", trim_currency=True
    ).withColumn(
        "local_amount", keys.money(keys.money("operation_amount") * F.col("exchange_rate"))
    )


@query
def fx_lookup_unmatched(spark, sf):
    moves = read.host_to_host(role(spark, sf, "host_to_host"), ODATE)
    return lookups.convert_currency(
        moves, _rates(spark, sf), "operation_currency_type", "transaction_date", how="left_anti"
    )


@query
def fx_lookup_month_end(spark, sf):
    return read.month_end_rates(role(spark, sf, "rates"), ODATE)


@query
def catalogue_lookup(spark, sf):
    keyed = read.commissions(role(spark, sf, "commissions"), ODATE)
    return lookups.with_concept(
        keyed, snapshots.catalogue_of(_catalogue(spark, sf), "SIC"), "concept_key"
    )


@query
def signed_catalogue_lookup(spark, sf):
    moves = read.general_movements(role(spark, sf, "general_movements"), ODATE)
    coded = lookups.with_concept(
        moves,
        snapshots.coded_concepts(_catalogue(spark, sf)),
        "movement_key",
        "data_code_id",
        "sign_type",
        F.col("commercial_product_type").alias("product_cat"),
    )
    return coded.withColumn(
        "signed_amount", keys.flipped_if(F.col("sign_type") == "+", "transaction_amount")
    )


@query
def issuance_join(spark, sf):
    return families.join_issuances(
        read.debit_movements(role(spark, sf, "debits"), ODATE),
        read.debit_issuances(role(spark, sf, "issuances"), ODATE),
    )


# --- concepts --------------------------------------------------------------


def _sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    frames = roles(
        spark,
        sf,
        *"accounts catalogue rates transfers collections cheques debits issuances".split(),
        *"dispersals host_to_host payrolls earlier_facts general_movements".split(),
        *"commissions branch_commissions".split(),
    )
    return {**frames, "deposits": frames["cheques"]}


def _one_family(spark: SparkSession, sf: str, source: families.Source) -> DataFrame:
    return concepts.concept_rollup(
        [source], role(spark, sf, "accounts"), _catalogue(spark, sf), ODATE
    )


def _sit(spark: SparkSession, sf: str) -> families.Source:
    moves = read.transfers(role(spark, sf, "transfers"), ODATE, DATEM)
    return families.sit(moves, _rates(spark, sf))


@query
def detail_imp_ope(spark, sf):
    copies = snapshots.open_account_copies(role(spark, sf, "accounts"), ODATE)
    sums = concepts.keep_open_accounts(concepts.detail_sums([_sit(spark, sf)]), copies)
    return concepts.amount_and_count_rows(sums).select(
        "account_id", "primary_key_type", "analytic_concept_amount"
    )


@query
def concept_sit(spark, sf):
    return _one_family(spark, sf, _sit(spark, sf))


@query
def concept_cie(spark, sf):
    moves = read.collections_by_agreement(role(spark, sf, "collections"), ODATE, DATEM)
    return _one_family(spark, sf, families.cie(moves, _rates(spark, sf)))


@query
def concept_tib_dem(spark, sf):
    stored = role(spark, sf, "cheques")
    source = families.tib_dem(
        read.cheques(stored, ODATE, DATEM),
        read.cheque_deposits(stored, ODATE, DATEM),
        _rates(spark, sf),
    )
    return _one_family(spark, sf, source)


@query
def concept_die(spark, sf):
    return _one_family(spark, sf, families.die(read.dispersals(role(spark, sf, "dispersals"), ODATE)))


@query
def concept_dom(spark, sf):
    source = families.dom(
        read.debit_movements(role(spark, sf, "debits"), ODATE),
        read.debit_issuances(role(spark, sf, "issuances"), ODATE),
    )
    return _one_family(spark, sf, source)


@query
def concept_h2h(spark, sf):
    moves = read.host_to_host(role(spark, sf, "host_to_host"), ODATE)
    return _one_family(spark, sf, families.h2h(moves, _rates(spark, sf)))


@query
def concept_nom(spark, sf):
    return _one_family(spark, sf, families.nom(read.payrolls(role(spark, sf, "payrolls"), ODATE)))


@query
def concept_b40w(spark, sf):
    moves = read.general_movements(role(spark, sf, "general_movements"), ODATE)
    return concepts.signed_movements(
        moves, role(spark, sf, "accounts"), _catalogue(spark, sf), ODATE
    )


@query
def concept_sicoco(spark, sf):
    moves = read.commissions(role(spark, sf, "commissions"), ODATE)
    return concepts.commission_concepts(
        moves, role(spark, sf, "accounts"), _catalogue(spark, sf), ODATE
    )


@query
def concept_sicoco5(spark, sf):
    moves = read.branch_commissions(role(spark, sf, "branch_commissions"), ODATE)
    return concepts.branch_commission_concepts(
        moves, role(spark, sf, "accounts"), _catalogue(spark, sf), ODATE
    )


@query
def profit_first_part(spark, sf):
    return profit.base_concepts(_sources(spark, sf), ODATE)


@query
def concept_all(spark, sf):
    return profit.profit_facts(_sources(spark, sf), ODATE, DATEM)


def _with_stored_accounts(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    path = scratch_path(spark, "accounts")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = path.rsplit("/", 1)[1].replace("-", "_")
    return {**tables, "accounts": sinks.store_bucketed(tables["accounts"], name, "account_id", buckets, path)}


@query
def concept_restated(spark, sf):
    """Transfers, collections and cheques of a month: a first delivery, then late rows alone."""
    tables, path = _sources(spark, sf), scratch_path(spark, "sums")
    restate.keep_delivery(tables, path, ODATE, FIRST_DELIVERY)
    restate.keep_delivery(tables, path, ODATE, DATEM, after=FIRST_DELIVERY)
    specs = [family for _, family in restate.late_sources(tables, ODATE, DATEM)]
    catalogue = snapshots.current_catalogue(tables["catalogue"])
    return restate.restated_facts(spark, path, tables["accounts"], catalogue, ODATE, DATEM, specs)


@query
def concept_all_staged(spark, sf):
    """As ``concept_all``, the accounts stored by account and the first part between the two."""
    tables = _with_stored_accounts(spark, _sources(spark, sf))
    path = scratch_path(spark, "profit-first-part")
    sinks.overwrite(profit.base_concepts(tables, ODATE), path)
    return profit.profit_facts(tables, ODATE, DATEM, base=files.read_zone(spark, path))


@query
def balance_export(spark, sf):
    return ingest.balance_export(
        role(spark, sf, "balances"), role(spark, sf, "branches"), "1998-03-31", ODATE
    )


@query
def customer_universe(spark, sf):
    r = roles(spark, sf, "customers", "known_customers", "contract_holders")
    return customers.customer_universe(
        r["customers"], r["known_customers"], r["contract_holders"], ODATE
    )


@query
def customers_sharing_tax_id(spark, sf):
    r = roles(spark, sf, "customers", "known_customers")
    tax_ids = customers.customer_tax_ids(r["customers"], ODATE)
    return customers.sharing_tax_id(
        customers.known_customers(r["known_customers"], tax_ids, ODATE), tax_ids
    )


# --- zone jobs and sinks ---------------------------------------------------

# A declared table in the schema-file layout.
_REQUEST_FIELDS = [
    ("request_id", "int32", "NUMERIC LARGE", False),
    ("priority_name", ["string", "null"], "ALPHANUMERIC(15)", False),
    ("request_amount", ["null", "decimal(17,2)"], "DECIMAL(17,2)", False),
    ("request_date", ["date", "null"], "DATE", False),
    ("status_type", ["string", "null"], "ALPHANUMERIC(2)", False),
    ("load_date", "date", "DATE", True),
]
REQUEST_SCHEMA = {
    "name": "requests",
    "partitions": ["load_date"],
    "fields": [
        {"name": n, "type": t, "logicalFormat": lf, "metadata": m}
        for n, t, lf, m in _REQUEST_FIELDS
    ],
}


def _requests(spark: SparkSession, sf: str, keep: str | None = None) -> DataFrame:
    return ingest.raw_to_master(
        role(spark, sf, "raw_orders"), read_table_schema(REQUEST_SCHEMA), keep
    )


@query
def ingest_raw_to_master(spark, sf):
    return _requests(spark, sf)


@query
def ingest_one_load(spark, sf):
    return _requests(spark, sf, f"load_date = '{ODATE}'")


@query
def ingest_landing_to_raw(spark, sf):
    raw_schema = read_table_schema(REQUEST_SCHEMA, raw=True)
    path = scratch_path(spark, "landing")
    landing = role(spark, sf, "raw_orders").drop("load_date")
    landing.write.options(sep="|", header=False, quote='"', ignoreLeadingWhiteSpace=False,
                          ignoreTrailingWhiteSpace=False).csv(path)
    read_back = files.read_delimited(
        spark, path, landing.schema, sep="|", header=False, multi_line=True
    )
    return ingest.landing_to_raw(read_back, {"load_date": ODATE}, raw_schema)


@query
def sink_append_roundtrip(spark, sf):
    rows = _requests(spark, sf)
    path = scratch_path(spark, "append")
    sinks.append_partitioned(rows.where("status_type = 'F'"), path, "load_date")
    sinks.append_partitioned(rows.where("status_type <> 'F' OR status_type IS NULL"), path, "load_date")
    return files.read_zone(spark, path, schema=rows.schema)


@query
def sink_reprocess_roundtrip(spark, sf):
    rows = _requests(spark, sf)
    path = scratch_path(spark, "reprocess")
    sinks.create(rows, path, "load_date")
    again = rows.where(F.col("load_date") == dates.as_date(ODATE)).withColumn(
        "request_amount", keys.money(F.col("request_amount") * 2)
    )
    for _ in range(2):
        sinks.replace_partition(again, path, "load_date", ODATE)
    return files.read_zone(spark, path, schema=rows.schema)


@query
def csv_export_roundtrip(spark, sf):
    rows = ingest.balance_export(
        role(spark, sf, "balances"), role(spark, sf, "branches"), "1998-03-31", ODATE
    )
    path = scratch_path(spark, "export")
    names = sinks.export_text(rows, path, "balances.txt", sep="|")
    paths = [f"{path}/{n}" for n in names]
    return files.read_delimited(spark, paths, T.StructType(rows.schema.fields), sep="|")


@query
def conform_fact(spark, sf):
    shuffled = role(spark, sf, "earlier_facts").select(
        "cutoff_date", "analytic_concept_amount", "account_id", "analytic_concept_id",
        "sender_application_id", "commercial_subproduct_type", "commercial_product_type",
    )
    return conform(shuffled, profit.as_fact(shuffled).schema)


@query
def sink_overwrite_roundtrip(spark, sf):
    rows = _requests(spark, sf)
    path = scratch_path(spark, "overwrite")
    sinks.overwrite(rows.where("status_type = 'F'"), path)
    sinks.overwrite(rows, path, files=2)
    return files.read_zone(spark, path)


@query
def csv_to_parquet_roundtrip(spark, sf):
    rows = _requests(spark, sf)
    base = scratch_path(spark, "convert")
    rows.write.options(sep="|", header=True).csv(f"{base}/csv")
    for replace in (False, True):
        ingest.delimited_to_table(
            spark, f"{base}/csv", rows.schema, f"{base}/table", "load_date", replace=replace
        )
    return files.read_zone(spark, f"{base}/table", schema=rows.schema)


@query
def spark_json_schema_roundtrip(spark, sf):
    """A schema kept in Spark's JSON form, stored as text and used to read a delimited file."""
    rows = _requests(spark, sf)
    base = scratch_path(spark, "json-schema")
    rows.write.options(sep="|", header=True).csv(f"{base}/csv")
    spark.createDataFrame([(rows.schema.json(),)], "value string").write.text(f"{base}/schema")
    stored = spark.read.text(f"{base}/schema", wholetext=True).first()["value"]
    return files.read_delimited(spark, f"{base}/csv", read_spark_schema(json.loads(stored)), sep="|")


@query
def partition_presence(spark, sf):
    return files.partitions_present(
        _requests(spark, sf), "load_date", [ODATE, "1990-01-31", "2000-02-29"]
    )


@query
def partition_presence_listed(spark, sf):
    path = _partitioned(spark, _requests(spark, sf).select("request_id", "load_date"), "load_date")
    return files.listed_partitions_present(spark, path, "load_date", [ODATE, "1990-01-31", "2000-02-29"])


@query
def csv_codes_roundtrip(spark, sf):
    """Codes with leading zeros, a byte-order mark, and one typed column."""
    orders = table(spark, sf, "orders").select(
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("code"),
        F.col("o_totalprice").cast("decimal(17,2)").alias("amount"),
        F.col("o_orderkey").alias("order_number"),
    )
    path = scratch_path(spark, "codes")
    names = sinks.export_text(orders, path, "codes.csv", byte_order_mark=True)
    return files.read_text_columns(
        spark,
        [f"{path}/{n}" for n in names],
        types={"amount": "decimal(17,2)", "order_number": "bigint"},
    )


@query
def padded_csv_roundtrip(spark, sf):
    """Space-padded values and headers, nulls written as a word."""
    padded = _requests(spark, sf).select(
        F.lpad(F.col("request_id").cast("string"), 12, " ").alias("  request_id "),
        F.rpad(F.coalesce("status_type", F.lit("null")), 8, " ").alias("status_type "),
        F.lpad(F.col("load_date").cast("string"), 12, " ").alias(" load_date"),
    )
    path = scratch_path(spark, "padded")
    padded.write.options(
        sep="|", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    schema = T.StructType.fromDDL("request_id int, status_type string, load_date date")
    return files.read_padded(spark, path, schema)


@query
def control_count_roundtrip(spark, sf):
    path = scratch_path(spark, "control")
    counted = table(spark, sf, "orders").agg(F.count("*").cast("string").alias("n"))
    counted.select(F.concat_ws("|", F.lit("orders"), F.lit(ODATE), "n").alias("value")).write.text(path)
    return files.read_control(spark, path)


def _record(name: str) -> Column:
    answer = F.when(F.col("p_size") > 10, F.concat(F.lit("|"), "p_type")).otherwise(F.lit(""))
    option = F.when(F.col("p_size") > 30, F.concat(F.lit("??"), "p_brand")).otherwise(F.lit(""))
    return F.concat(name, F.lit(" "), F.col("p_partkey").cast("string"), option, answer)


@query
def record_file_split(spark, sf):
    """Records of a text file with ``;`` between them."""
    path = scratch_path(spark, "records")
    table(spark, sf, "part").select(_record("p_name").alias("value")).write.option(
        "lineSep", ";"
    ).text(path)
    return textmatch.split_questions(files.read_records(spark, path)).drop("file", "offset")


def _block_files(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as question and options between blank lines; a large part has no options."""
    path = scratch_path(spark, "blocks")
    options = F.when(F.col("p_size") <= 40, F.concat_ws("\n", "p_type", "p_brand", F.lit("")))
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    table(spark, sf, "part").select(F.concat_ws("\n", name, F.coalesce(options, F.lit(""))).alias("value")).write.text(path)
    return positions.gathered_records(spark, path, textmatch.blank_line())


@query
def text_blocks_split(spark, sf):
    return textmatch.split_blocks(_block_files(spark, sf)).select("questions", "options", "answers")


@query
def text_blocks_quarantine(spark, sf):
    bad = textmatch.quarantined_blocks(_block_files(spark, sf))
    return bad.select(F.element_at(F.filter("lines", lambda x: x != ""), 1).alias("question"))


def _marked_files(spark: SparkSession, sf: str) -> DataFrame:
    """Parts below marker lines; a small part has no answer."""
    path = scratch_path(spark, "marked")
    answer = F.when(F.col("p_size") > 10, F.concat(F.lit("\t"), "p_type")).otherwise(F.lit(""))
    record = F.concat(F.lit("Question\n"), "p_name", F.lit("\n"), F.col("p_partkey").cast("string"), answer)
    table(spark, sf, "part").select(record.alias("value")).write.text(path)
    return positions.gathered_records(spark, path, textmatch.marker_line())


@query
def text_marked_split(spark, sf):
    return textmatch.split_marked(_marked_files(spark, sf)).select("questions", "options", "answers")


@query
def text_marked_quarantine(spark, sf):
    return textmatch.quarantined_marked(_marked_files(spark, sf)).select(F.array_join("lines", "|").alias("record"))


@query
def merged_files_deduped(spark, sf):
    """Two exports read together; of equal names the first file's first row stays."""
    base = scratch_path(spark, "merge")
    part = table(spark, sf, "part")
    shown = F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))
    first = part.where("p_size <= 25").select(F.lit(1).alias("file_no"), "p_partkey", shown.alias("name"))
    second = part.where("p_size > 25").select(F.lit(2).alias("file_no"), "p_partkey", F.col("p_name").alias("name"))
    for number, rows in enumerate((first, second)):
        rows.write.options(
            header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(f"{base}/{number}")
    both = files.read_delimited(spark, [f"{base}/0", f"{base}/1"], first.schema)
    return textmatch.dedupe_by_text(both, "name", "file_no", "p_partkey")


# --- quality and profiles --------------------------------------------------


def _request_rules(spark: SparkSession, sf: str) -> list[quality.Rule]:
    control = table(spark, sf, "customer").agg(F.count("*").alias("expected"))
    rules = [
        quality.NotEmpty(),
        quality.MatchesControlCount(control=control),
        quality.MatchesDatasetCount(dataset=table(spark, sf, "orders")),
        quality.MatchesDatasetCount(
            dataset=role(spark, sf, "raw_orders"), condition=f"load_date = '{ODATE}'"
        ),
        quality.NotNull(columns=("request_id", "load_date")),
        quality.NotNull(columns=("status_type",), min_threshold=60.0, acceptance_min=50.0),
        quality.DateEquals(column="load_date", value=f"{ODATE} 00:00:00", critical=False),
        quality.MatchesPattern(column="status_type", min_threshold=10.0),
    ]
    return rules + quality.length_rules({"priority_name": 8}, critical=False)


@query
def dq_report(spark, sf):
    return quality.evaluate(_requests(spark, sf), _request_rules(spark, sf))


@query
def dq_report_from_state(spark, sf):
    """Requests by year: some years are counted, the others arrive, and only those are counted then."""
    path, state = scratch_path(spark, "requests"), scratch_path(spark, "quality-state")
    rows = _requests(spark, sf).withColumn("load_year", F.year("load_date"))
    rules = _request_rules(spark, sf)
    for some in (F.col("load_year") < 1998, F.col("load_year") >= 1998):
        sinks.append_partitioned(rows.where(some), path, "load_year")
        quality.update_counters(spark, path, "load_year", rules, state)
    return quality.evaluate_state(spark.read.parquet(state), rules)


@query
def dq_report_subset(spark, sf):
    rules = [
        quality.DateEquals(column="load_date", value=ODATE),
        quality.MatchesDatasetCount(
            dataset=role(spark, sf, "raw_orders"), condition=f"load_date = '{ODATE}'"
        ),
        quality.NotNull(columns=("request_id", "status_type"), critical=False),
    ]
    return quality.evaluate(_requests(spark, sf), rules, subset=f"load_date = DATE '{ODATE}'")


@query
def dq_refusals(spark, sf):
    rules = [
        quality.NotNull(columns=("request_id", "status_type")),
        quality.MaxLength(column="priority_name", limit=8),
    ]
    return quality.refusals(_requests(spark, sf), rules)


@query
def dq_acceptance(spark, sf):
    return quality.acceptance(_requests(spark, sf), role(spark, sf, "raw_orders"))


@query
def dq_max_length(spark, sf):
    limits = {"text": 5000, "lang": 2, "source": 20}
    return quality.evaluate(table(spark, sf, "documents"), quality.length_rules(limits))


@query
def dq_files_per_partition(spark, sf):
    path = scratch_path(spark, "files")
    sinks.append_partitioned(_requests(spark, sf), path, "load_date")
    found = quality.files_per_directory(spark, path)
    return found.select(
        "directory", (F.col("files") > 0).alias("has_files"), (F.col("size_mb") > 0).alias("has_bytes"), "ok"
    )


def _mixed_dates(spark: SparkSession, sf: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "O", F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderstatus") == "F", F.date_format(day, "d/M/yyyy"))
        .alias("visit_start_date"),
        F.when(F.col("o_orderpriority") < "3", F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
        .alias("visit_end_date"),
    )


_DATE_COLUMNS = ["visit_start_date", "visit_end_date"]


@query
def preview_rows(spark, sf):
    return profiling.preview(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey"), 4, ["o_orderkey"])


@query
def profile_dates(spark, sf):
    return profiling.format_audit(_mixed_dates(spark, sf), _DATE_COLUMNS)


@query
def profile_dates_off_format(spark, sf):
    return profiling.off_format_values(_mixed_dates(spark, sf), _DATE_COLUMNS)


@query
def profile_null_positions(spark, sf):
    return profiling.null_positions(_mixed_dates(spark, sf), _DATE_COLUMNS, "o_orderkey")


@query
def null_positions_in_files(spark, sf):
    """Rows of several files in order, the number of each row without a status."""
    path = scratch_path(spark, "positions")
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status_type")
    orders = table(spark, sf, "orders").select("o_orderkey", status, "o_orderpriority")
    orders.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").write.csv(path, header=True)
    numbered = positions.in_file_order(files.read_delimited(spark, path, orders.schema), across_files=True)
    return profiling.null_positions(numbered, ["o_orderkey", "status_type"], "row_number")


@query
def parse_dates_lenient(spark, sf):
    return transforms.parse_dates("visit_.*_date", "dd/MM/yyyy", strict=False)(
        _mixed_dates(spark, sf)
    )


@query
def parse_dates_strict(spark, sf):
    day = F.date_format(F.to_date("o_orderdate"), "dd/MM/yyyy")
    written = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", day).alias("visit_start_date")
    )
    return transforms.parse_dates("visit_.*_date", "dd/MM/yyyy", strict=True)(written)


MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()


@query
def parse_dates_in_words(spark, sf):
    """Order dates in two writings, one of them with Spanish month names."""
    day = F.col("o_orderdate").cast("date")
    month = F.element_at(F.array(*map(F.lit, MONTHS)), F.month(day))
    in_words = F.concat_ws(" de ", F.date_format(day, "dd"), month, F.date_format(day, "yyyy"))
    written = F.when(F.col("o_orderkey") % 2 == 0, in_words).otherwise(F.date_format(day, "dd/MM/yyyy"))
    orders = table(spark, sf, "orders").select("o_orderkey", written.alias("order_date"))
    return transforms.parse_dates("order_date", ["dd/MM/yyyy", "dd 'de' MMMM 'de' yyyy"], locale="es-MX")(orders)


@query
def profile_nulls(spark, sf):
    return profiling.null_counts(_requests(spark, sf))


@query
def profile_required(spark, sf):
    schema = read_table_schema(
        {
            "fields": [
                {"name": "request_id", "type": "int32"},
                {"name": "status_type", "type": "string"},
                {"name": "absent_column", "type": "string"},
                {"name": "priority_name", "type": ["string", "null"]},
            ]
        }
    )
    return profiling.null_audit(_requests(spark, sf), schema)


@query
def null_rows_filled(spark, sf):
    gaps = profiling.rows_with_null(_requests(spark, sf), "status_type")
    return transforms.fill_nulls({"status_type": "UNKNOWN"})(gaps)


@query
def distinct_values_by_field(spark, sf):
    return profiling.distinct_values(table(spark, sf, "documents"), "lang", "source")


@query
def value_digest(spark, sf):
    return profiling.column_digest(
        table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"]
    )


@query
def clean_chain(spark, sf):
    prices = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        F.regexp_replace(F.col("o_totalprice").cast("decimal(17,2)").cast("string"), "[.]", ",").alias(
            "total_amount"
        ),
        F.concat_ws(" / ", "o_orderpriority", "o_orderstatus", "o_orderpriority", "o_orderpriority").alias(
            "person_name"
        ),
    )
    return transforms.pipeline(
        prices,
        transforms.decimal_comma_to_point("amount"),
        transforms.truncate("person_name", 25),
        transforms.cast_columns("total_amount", "decimal(17,2)"),
        transforms.rename_in_order(["visit_id", "visit_amount", "visit_person_name"]),
    )


# --- text ------------------------------------------------------------------


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return textmatch.cut_records(table(spark, sf, "documents"), "text", "\n", "doc_id")


@query
def text_records_split(spark, sf):
    return textmatch.split_questions(_lines(spark, sf), ",", r"[.]+")


@query
def text_records_quarantine(spark, sf):
    return textmatch.quarantined_records(_lines(spark, sf), ",")


@query
def text_dedupe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return textmatch.dedupe_by_text(docs, "text", "doc_id")


@query
def text_topk_levenshtein(spark, sf):
    talk = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return textmatch.closest(talk, "text", QUESTION, 10, ["conv_id", "turn"])


QUESTIONS = [QUESTION, "What does the ander of the thering do", "Che la anda"]


@query
def text_topk_each_question(spark, sf):
    talk = table(spark, sf, "conversations").select("conv_id", "turn", "text")
    return textmatch.closest_each(talk, "text", QUESTIONS, 5, ["conv_id", "turn"])


def _indexed_talk(spark: SparkSession, sf: str) -> textindex.GramIndex:
    path = scratch_path(spark, "grams")
    textindex.store_gram_index(table(spark, sf, "conversations").select("conv_id", "turn", "text"), "text", path)
    return textindex.GramIndex(spark, path, "text")


@query
def text_topk_indexed(spark, sf):
    return _indexed_talk(spark, sf).closest(QUESTION, 10, ["conv_id", "turn"])


@query
def text_topk_each_indexed(spark, sf):
    return _indexed_talk(spark, sf).closest_each(QUESTIONS, 5, ["conv_id", "turn"])


@query
def text_index_effort(spark, sf):
    """Whether the index spares rows, per question."""
    effort = _indexed_talk(spark, sf).effort(QUESTIONS, 5)
    return effort.select("question", "rows", (F.col("scored") < F.col("rows")).alias("spared"))
