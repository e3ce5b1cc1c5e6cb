"""Banking roles played by the test tables.

Each role is one SELECT that Spark and DuckDB both understand, so that a Spark
query and its comparison SQL start from the same rows.  Everything after the role
is written twice: as library calls in ``queries`` and as plain SQL in ``oracles``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerloom.plans import families as f

ODATE = "1998-03-31"
DATEM = "1998-04-05"
MONTH_START = "1998-03-01"
CATALOGUE_CUTOFF = "1998-04-30"

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents pages benchmark labels conversations"
).split()

# One line item with its order's customer as account, dates without time.
_LINES = """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS acct,
       CAST(o_custkey AS STRING) AS cust,
       CAST(l_shipdate AS DATE) AS ship,
       CAST(l_shipdate AS DATE) + l_linenumber AS arrival,
       l_orderkey, l_linenumber, l_returnflag, l_linestatus, l_quantity, l_discount, l_tax,
       CAST(l_extendedprice AS DECIMAL(17,2)) AS price,
       CASE WHEN l_linenumber <= 3 THEN 'MXP' WHEN l_linenumber <= 5 THEN 'USD' ELSE 'EUR' END AS ccy
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# A rate per currency and day, except for the euro on the 15th, and noise rows
# (monthly kind) dated at month end.
_RATE_DAYS = """
SELECT DISTINCT CASE WHEN l_linenumber <= 3 THEN 'MXP' WHEN l_linenumber <= 5 THEN 'USD' ELSE 'EUR' END AS ccy,
       CAST(l_shipdate AS DATE) AS d
FROM lineitem
"""
_RATE_VALUE = """CAST(CASE ccy WHEN 'MXP' THEN CAST('1.000000' AS DECIMAL(17,6))
            WHEN 'USD' THEN CAST('17.123456' AS DECIMAL(17,6))
            ELSE CAST('19.654321' AS DECIMAL(17,6)) END
       + CAST(day(d) AS DECIMAL(17,6)) / CAST(100 AS DECIMAL(17,6)) AS DECIMAL(17,6))"""

ROLES: dict[str, str] = {
    "accounts": """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS account_id,
       substr(o_orderpriority, 1, 1) AS commercial_product_type,
       substr(o_orderpriority, 3, 4) AS commercial_subproduct_type,
       CAST(o_custkey AS STRING) AS gl_branch_id,
       CASE WHEN o_orderstatus = 'F' THEN 'T' WHEN o_orderstatus = 'P' THEN NULL ELSE 'A' END AS contract_status_type,
       CAST(o_orderdate AS DATE) AS cutoff_date
FROM orders""",
    "rates": f"""
SELECT '0074' AS entity_id, ccy AS currency_id, 'MXP' AS outgoing_currency_id,
       'D' AS exchange_currency_type, 'S' AS currency_quote_type,
       {_RATE_VALUE} AS exchange_currency_min_amount, d AS load_date
FROM ({_RATE_DAYS}) AS days WHERE NOT (ccy = 'EUR' AND day(d) = 15)
UNION ALL
SELECT '0074', ccy, 'MXP', 'M', 'S', {_RATE_VALUE}, d
FROM ({_RATE_DAYS}) AS days WHERE d = last_day(d)""",
    "transfers": f"""
SELECT CAST(l_orderkey AS STRING) AS agreement_id, ship AS sit_transaction_date, arrival AS load_date,
       ccy AS operation_currency_id, price AS total_transaction_amount,
       l_returnflag AS sender_application_id,
       CASE WHEN l_linestatus = 'F' THEN 'CO' ELSE 'PE' END AS operation_status_type,
       acct AS dispersal_account_id
FROM ({_LINES}) AS m""",
    "collections": f"""
SELECT CAST(l_orderkey AS STRING) AS agreement_id, ship AS transaction_date, ship AS value_date,
       arrival AS load_date, ccy || ' ' AS currency_id,
       CAST(price AS DECIMAL(20,4)) + CAST('0.0051' AS DECIMAL(20,4)) AS operation_amount,
       acct AS credit_internal_account_id, l_returnflag AS transaction_channel_type,
       CASE WHEN l_linestatus = 'F' THEN 'CO' ELSE 'PE' END AS srce_appl_operation_status_type
FROM ({_LINES}) AS m""",
    "cheques": f"""
SELECT ship AS transfer_debit_date, arrival AS load_date,
       CASE WHEN l_linestatus = 'F' THEN ' PR ' ELSE 'RE' END AS check_status_id,
       CASE l_linenumber WHEN 1 THEN 'B' WHEN 2 THEN 'D' WHEN 3 THEN '3' WHEN 4 THEN '4'
                         WHEN 5 THEN '5' WHEN 6 THEN ' C ' ELSE '1' END AS cie_transaction_type,
       CASE WHEN l_tax = 0 THEN 'N/A' ELSE CAST(CAST(l_quantity AS INT) * 2 AS STRING) END AS contract_currency_id,
       CASE WHEN l_returnflag = 'R' THEN acct ELSE ' ' || acct || ' ' END AS credit_internal_account_id,
       CASE l_returnflag WHEN 'A' THEN '00' WHEN 'N' THEN '07' END AS return_reason_type,
       price AS cash_payment_amount, CAST(price + 1 AS DECIMAL(17,2)) AS dpst_file_checks_tot_amount,
       CAST(price + 2 AS DECIMAL(17,2)) AS check_amount
FROM ({_LINES}) AS m""",
    "dispersals": f"""
SELECT CASE WHEN l_linenumber <= 3 THEN 'PAGO' ELSE 'CREDITO' END AS movement_desc, ccy AS currency_id,
       CASE WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(17,2)) ELSE price END AS fee_amount,
       CASE WHEN l_linestatus = 'F' THEN 'P001' ELSE 'P002' END AS transaction_status_type,
       ship AS value_date, acct AS agreement_dispersal_acct_id,
       CASE l_returnflag WHEN 'A' THEN 'INET' WHEN 'N' THEN '  ' END AS channel_id
FROM ({_LINES}) AS m""",
    "issuances": f"""
SELECT CAST(l_orderkey AS STRING) AS issuing_id, acct AS source_account_id,
       CASE l_returnflag WHEN 'A' THEN 'O' WHEN 'N' THEN 'M' ELSE 'I' END AS source_channel_id,
       ship AS load_date
FROM ({_LINES}) AS m""",
    "debits": f"""
SELECT CAST(l_orderkey AS STRING) AS issuing_id,
       CASE WHEN l_linestatus = 'F' THEN 'RO' ELSE 'RE' END AS collecting_mark_type,
       ship AS auto_payments_clct_proc_date, price AS debit_amount, l_linenumber AS issued_receipt_number
FROM ({_LINES}) AS m""",
    "host_to_host": f"""
SELECT ' ' || acct || ' ' AS primary_subject_id, ccy || '  ' AS operation_currency_type,
       CASE l_returnflag WHEN 'A' THEN 'SRVT008' WHEN 'N' THEN 'SRVT009 ' ELSE 'T8' END AS subservice_type,
       ship AS transaction_date,
       CASE WHEN l_discount = 0 THEN NULL ELSE price END AS transaction_amount
FROM ({_LINES}) AS m""",
    "payrolls": f"""
SELECT acct AS commerce_account_id, ship AS payroll_customer_deposit_date, price AS payroll_amount,
       CASE l_returnflag WHEN 'A' THEN 'BANXICO' WHEN 'R' THEN 'INTERNET' END AS payroll_channel_id
FROM ({_LINES}) AS m""",
    "general_movements": f"""
SELECT 'B' || l_returnflag AS bg_operation_id, l_linestatus AS transaction_id,
       substr(acct, 1, 4) AS counterpart_id, substr(acct, 5, 6) AS folio_contract_id,
       'movement ' || l_linestatus AS transaction_desc, ccy AS currency_id,
       arrival AS load_date, ship AS transaction_date,
       CASE WHEN l_discount = 0 THEN NULL ELSE price END AS transaction_amount
FROM ({_LINES}) AS m""",
    "commissions": f"""
SELECT 'MX' || acct AS commission_account_id,
       'CARD-XY' || '0' || CAST(l_linenumber AS STRING) AS card_service_type,
       last_day(ship) AS cutoff_date, price AS total_commission_tax_amount
FROM ({_LINES}) AS m""",
    "branch_commissions": f"""
SELECT '  MX' || CASE WHEN l_returnflag = 'A' THEN acct ELSE cust END || ' ' AS commission_account_id,
       CASE WHEN l_linenumber > 5 THEN '1' || CAST(l_linenumber AS STRING)
            ELSE CAST(l_linenumber AS STRING) END AS card_service_type,
       last_day(ship) AS cutoff_date, price AS total_commission_tax_amount
FROM ({_LINES}) AS m""",
    "earlier_facts": """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS account_id, '1010' AS analytic_concept_id,
       'BAL' AS sender_application_id, substr(o_orderpriority, 1, 1) AS commercial_product_type,
       o_orderstatus AS commercial_subproduct_type,
       CAST(o_totalprice AS DECIMAL(17,2)) AS analytic_concept_amount, last_day(CAST(o_orderdate AS DATE)) AS cutoff_date
FROM orders""",
    "balances": """
SELECT CAST(o_orderdate AS DATE) AS gl_date, CAST(c_nationkey AS STRING) AS gl_branch_id,
       substr(o_orderpriority, 1, 1) AS manager_id, CAST(c_custkey AS STRING) AS customer_id,
       CAST(o_orderkey AS STRING) AS contract_id, lpad(CAST(c_custkey AS STRING), 10, '0') AS account_id,
       o_orderstatus AS sender_application_id, substr(o_orderpriority, 1, 1) AS commercial_product_type,
       substr(o_orderpriority, 3, 4) AS commercial_subproduct_type, 'MXP' AS origin_currency_id,
       CAST(o_orderdate AS DATE) AS account_opening_date,
       last_day(CAST(o_orderdate AS DATE)) AS current_contract_expiration_date,
       12 AS contract_duration_number, CAST(o_totalprice AS DECIMAL(37,2)) AS current_balance_amount,
       CAST(o_totalprice AS DECIMAL(37,2)) AS current_bal_local_curncy_amount,
       CAST(c_acctbal AS DECIMAL(37,2)) AS overdue_balance_amount,
       CAST(c_acctbal AS DECIMAL(37,2)) AS overdue_bal_local_curncy_amount,
       last_day(CAST(o_orderdate AS DATE)) AS cutoff_date,
       CAST(o_totalprice AS DECIMAL(37,2)) AS avg_bal_orig_curncy_amount,
       CAST(o_totalprice AS DECIMAL(37,2)) AS total_average_balance_amount
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "branches": f"""
SELECT CAST(n_nationkey AS STRING) AS branch_id,
       CASE n_regionkey WHEN 0 THEN '9047' WHEN 1 THEN '9105' ELSE '1000' END AS banking_type,
       DATE '{ODATE}' AS cutoff_date
FROM nation""",
    "contract_holders": """
SELECT CAST(o_custkey AS STRING) AS customer_id, ' ' || substr(o_orderpriority, 1, 1) AS product_type,
       lpad(CAST(o_orderkey AS STRING), 10, '0') || ' ' AS account_id,
       o_orderstatus AS account_register_branch_id,
       CASE WHEN o_orderstatus = 'F' THEN 'C' ELSE 'T' END AS account_intervention_type,
       CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN '02' ELSE '01' END AS account_interventon_id,
       last_day(CAST(o_orderdate AS DATE)) AS load_date
FROM orders""",
    "customers": f"""
SELECT CAST(c_custkey AS STRING) AS customer_id, c_mktsegment || ' ' AS rfc_id,
       ' ' || CAST(c_nationkey AS STRING) AS homoclave_name, DATE '{MONTH_START}' AS load_date
FROM customer""",
    "known_customers": """
SELECT CAST(o_custkey AS STRING) AS customer_id, CAST(o_orderdate AS DATE) AS cutoff_date FROM orders""",
    # Order rows as the text a landing file would hold.
    "raw_orders": """
SELECT ' ' || CAST(o_orderkey AS STRING) || ' ' AS request_id,
       o_orderpriority || '
 ' AS priority_name,
       ' ' || CAST(CAST(o_totalprice AS DECIMAL(17,2)) AS STRING) AS request_amount,
       CAST(CAST(o_orderdate AS DATE) AS STRING) AS request_date,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus || '  ' END AS status_type,
       CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS load_date
FROM orders""",
}


def _detail(key: str, code: str, product: str, sign: str = "-") -> tuple[str, ...]:
    return ("APP" + key[:3], key, key[:3], key[3:], sign, code, product, code)


def catalogue_rows() -> list[tuple[str, ...]]:
    """Concept catalogue: detail, subtotal and total rows of every family.

    Columns: sender, key, operation group, transaction, sign, code, product,
    subproduct.  Some keys of each family are left out on purpose.
    """
    details = {
        "SITA": ("4110", "6110"), "SITN": ("4130", "6130"),
        "CIEA": ("3210", "5210"), "CIEN": ("3230", "5230"),
        "TIBTIBB": ("3410", "5410"), "TIBTIBC": ("3410", "5410"),
        "TIBTIBD": ("3430", "5430"), "TIBTIB3": ("3430", "5430"),
        "DEMDEM4": ("3310", "5310"), "DEMDEM5": ("3330", "5330"),
        "DIEPAIN": ("4210", "6210"), "DIEPAOT": ("4230", "6230"), "DIECRIN": ("4230", "6230"),
        "DOMMANO": ("3620", "5620"), "DOMMANM": ("3620", "5620"), "DOMDIGI": ("3610", "5610"),
        "H2HT008": ("3710", "5710"), "H2HT009": ("3730", "5730"), "H2HT8": ("3999", "5999"),
        "NOMNOBX": ("4310", "6310"), "NOMNOOT": ("4330", "6330"),
    }
    rows = []
    for key, codes in details.items():
        for suffix, code in zip(("IMP", "OPE"), codes, strict=True):
            rows.append(_detail(key + suffix, code, code[:2]))
    upper = [
        (f.SIT_SUBTOTALS, f.SIT_TOTALS), (f.CIE_SUBTOTALS, f.CIE_TOTALS),
        (f.DIE_SUBTOTALS, f.DIE_TOTALS), (f.DOM_SUBTOTALS, f.DOM_TOTALS),
        (f.H2H_SUBTOTALS, f.H2H_TOTALS), (f.NOM_SUBTOTALS, f.NOM_TOTALS),
    ]
    for subtotals, totals in upper:
        rows += [_detail(key, code[:3] + "9", code[:2]) for code, key in subtotals.items()]
        rows += [_detail(key, product + "00", product) for product, key in totals.items()]
    rows += [_detail(key, code[:3] + "9", code[:2]) for code, key in f.CHEQUE_SUBTOTALS.items()]
    totals = {key: code[:2] for code, key in f.CHEQUE_TOTALS.items()}
    rows += [_detail(key, product + "00", product) for key, product in totals.items()]
    rows += [
        ("APPBG", "BAF", "BA", "F", "+", "7110", "71", "7110"),
        ("APPBG", "BNF", "BN", "F", "-", "7120", "71", "7120"),
        ("APPBG", "BRO", "BR", "O", "-", "7130", "71", "7130"),
        ("APPBG", "BNO", "BN", "O", "+", "", "71", "7140"),
    ]
    for n in ("01", "02", "03", "05"):
        rows.append(("APPSIC", "SICCOBRS" + n, "SIC", n, "-", "81" + n, "81", n))
    for n in ("01", "02", "04", "16"):
        rows.append(("APPSIC", "SICCOBR5" + n, "SIC", n, "-", "82" + n, "82", n))
    rows.append(("APPSIC", "SICCOBRS04", "OTH", "04", "-", "8104", "81", "04"))
    return rows


def catalogue_sql() -> str:
    """The catalogue at two cutoffs; the older one carries outdated codes."""
    values = ",\n".join(
        "(" + ", ".join(f"'{v}'" for v in row) + ")" for row in catalogue_rows()
    )
    names = (
        "sender_application_id, primary_key_type, bg_operation_id, transaction_id, sign_type, "
        "code, commercial_product_type, commercial_subproduct_type"
    )
    columns = (
        "sender_application_id, primary_key_type, bg_operation_id, transaction_id, sign_type, "
        "{code} AS data_code_id, commercial_product_type, commercial_subproduct_type, "
        "DATE '{cutoff}' AS cutoff_date"
    )
    rows = f"(SELECT * FROM (VALUES {values}) AS v({names})) AS c"
    current = columns.format(code="CASE WHEN code = '' THEN NULL ELSE code END", cutoff=CATALOGUE_CUTOFF)
    old = columns.format(code="'0000'", cutoff="1998-01-31")
    return f"SELECT {current} FROM {rows} UNION ALL SELECT {old} FROM {rows}"


ROLES["catalogue"] = catalogue_sql()


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables; its schema is read from the files only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows that play a banking role; only views of the tables used are made."""
    text = ROLES[name]
    frames = {t: table(spark, sf_dir, t) for t in TABLES if f" {t} " in f" {' '.join(text.split())} "}
    for t, frame in frames.items():
        text = text.replace(f"FROM {t}", "FROM {" + t + "}").replace(f"JOIN {t}", "JOIN {" + t + "}")
    return spark.sql(text, **frames)


def roles(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: role(spark, sf_dir, n) for n in names}
