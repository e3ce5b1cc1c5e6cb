"""Plain SQL for each registered query, for a side-by-side check in DuckDB.

The roll-ups are written step by step here (group, look up, group again), not as
the library plans them.
"""

from __future__ import annotations

from ledgerloom.plans import families as f
from ledgerloom.workload.queries import QUESTION, QUESTIONS
from ledgerloom.workload.roles import DATEM, MONTH_START, ODATE, ROLES

MONTH = f"BETWEEN DATE '{MONTH_START}' AND DATE '{ODATE}'"
ARRIVED = f"BETWEEN DATE '{MONTH_START}' AND DATE '{DATEM}'"


def _with(*names: str) -> str:
    return ",\n".join(f"{n}_rows AS ({ROLES[n]})" for n in names)


ACCOUNTS = f"""{_with("accounts")},
bounded AS (SELECT * FROM accounts_rows WHERE cutoff_date <= DATE '{ODATE}'),
newest AS (SELECT *, max(cutoff_date) OVER (PARTITION BY account_id) AS top_date FROM bounded WHERE account_id IS NOT NULL),
acc AS (SELECT account_id, commercial_product_type, commercial_subproduct_type, gl_branch_id
        FROM newest WHERE cutoff_date = top_date AND contract_status_type <> 'T')"""
CATALOGUE = f"""{_with("catalogue")},
cat AS (SELECT * FROM catalogue_rows WHERE cutoff_date = (SELECT max(cutoff_date) FROM catalogue_rows))"""
RATES = f"""{_with("rates")},
fx AS (SELECT load_date, currency_id, exchange_currency_min_amount AS rate FROM rates_rows
       WHERE entity_id = '0074' AND exchange_currency_type = 'D' AND currency_quote_type = 'S'
         AND outgoing_currency_id = 'MXP' AND load_date {MONTH})"""


def _times(amount: str) -> str:
    return f"CAST({amount} AS DECIMAL(20,2)) * CAST(rate AS DECIMAL(18,6))"


# --- readers -----------------------------------------------------------------

_SIT = f"""SELECT agreement_id, sit_transaction_date, operation_currency_id, total_transaction_amount,
       sender_application_id, operation_status_type, dispersal_account_id
FROM transfers_rows WHERE operation_status_type = 'CO' AND load_date {ARRIVED} AND sit_transaction_date {MONTH}"""
_CIE = f"""SELECT agreement_id, transaction_date, value_date, currency_id, operation_amount,
       credit_internal_account_id, srce_appl_operation_status_type, transaction_channel_type
FROM collections_rows WHERE srce_appl_operation_status_type = 'CO' AND load_date {ARRIVED} AND transaction_date {MONTH}"""
_CURRENCY = """CASE WHEN TRY_CAST(contract_currency_id AS INT) BETWEEN 20 AND 28 THEN 'USD'
            WHEN TRY_CAST(contract_currency_id AS INT) BETWEEN 70 AND 78 THEN 'USD' ELSE 'MXP' END"""
_PRESENTED = f"""load_date {ARRIVED} AND transfer_debit_date {MONTH} AND trim(check_status_id) = 'PR'
  AND trim(cie_transaction_type) IN ('B','C','D','E','3','4','5','6')"""


def _sign(amount: str) -> str:
    return f"CAST(CASE WHEN return_reason_type = '00' THEN {amount} ELSE -{amount} END AS DECIMAL(17,2))"


_CHQ = f"""SELECT transfer_debit_date, {_CURRENCY} AS currency_id, credit_internal_account_id, cie_transaction_type,
       check_status_id, {_sign("cash_payment_amount")} AS cash_tot_amount,
       {_sign("dpst_file_checks_tot_amount")} AS checks_tot_amount
FROM cheques_rows WHERE {_PRESENTED}"""
_DEP = f"""SELECT transfer_debit_date, {_CURRENCY} AS currency_id, credit_internal_account_id,
       CASE WHEN cie_transaction_type = '1' THEN '3' ELSE '4' END AS cie_transaction_type,
       check_status_id, {_sign("check_amount")} AS check_tot_amount
FROM cheques_rows WHERE {_PRESENTED}"""
_DIE = f"""SELECT movement_desc, currency_id, fee_amount, transaction_status_type, value_date,
       agreement_dispersal_acct_id, channel_id
FROM dispersals_rows WHERE fee_amount <> 0 AND transaction_status_type = 'P001' AND value_date {MONTH}"""
_EMI = f"""SELECT i.issuing_id, i.source_account_id, i.source_channel_id, i.load_date
FROM issuances_rows i JOIN (SELECT issuing_id, max(load_date) AS load_date FROM issuances_rows
     WHERE load_date {MONTH} GROUP BY issuing_id) m ON i.issuing_id = m.issuing_id AND i.load_date = m.load_date"""
_DEB = f"""SELECT issuing_id, debit_amount, issued_receipt_number, collecting_mark_type, auto_payments_clct_proc_date
FROM debits_rows WHERE auto_payments_clct_proc_date {MONTH} AND collecting_mark_type = 'RO' AND debit_amount <> 0"""
_H2H = f"""SELECT trim(primary_subject_id) AS primary_subject_id, trim(operation_currency_type) AS operation_currency_type,
       transaction_amount, trim(subservice_type) AS subservice_type, transaction_date
FROM host_to_host_rows WHERE transaction_date {MONTH} AND transaction_amount <> 0"""
_NOM = f"""SELECT commerce_account_id, payroll_amount, payroll_channel_id
FROM payrolls_rows WHERE payroll_customer_deposit_date {MONTH} AND payroll_amount <> 0"""
_B40 = f"""SELECT bg_operation_id || transaction_id AS movement_key, load_date, counterpart_id, folio_contract_id,
       transaction_date, transaction_id, transaction_desc, currency_id, transaction_amount
FROM general_movements_rows
WHERE load_date <= (SELECT max(load_date) FROM general_movements_rows WHERE load_date <= DATE '{ODATE}')
  AND load_date >= DATE '{MONTH_START}' AND transaction_date {MONTH}
  AND transaction_amount IS NOT NULL AND transaction_amount <> 0"""
_SIC = f"""SELECT substr(commission_account_id, 3, 10) AS commission_account_id, card_service_type,
       total_commission_tax_amount, 'SICCOBRS' || substr(card_service_type, 8, 2) AS concept_key
FROM commissions_rows WHERE cutoff_date = DATE '{ODATE}' AND total_commission_tax_amount <> 0"""
_SI5 = f"""SELECT substr(trim(commission_account_id), 3, 10) AS commission_account_id, card_service_type,
       total_commission_tax_amount
FROM branch_commissions_rows WHERE cutoff_date = DATE '{ODATE}' AND total_commission_tax_amount <> 0"""
_PADDED = """CASE WHEN length(commission_account_id) = 10 THEN commission_account_id
            ELSE lpad(CAST(TRY_CAST(commission_account_id AS INT) AS STRING), 10, '0') END"""


def _reader(name: str, body: str) -> str:
    return f"WITH {_with(name)} {body}"


def _joined(name: str, body: str, key: str, semi: bool = False) -> str:
    if semi:
        return (
            f"WITH {ACCOUNTS}, {_with(name)}, m AS ({body}) "
            f"SELECT m.* FROM m WHERE {key} IN (SELECT account_id FROM acc)"
        )
    return (
        f"WITH {ACCOUNTS}, {_with(name)}, m AS ({body}) "
        f"SELECT m.* FROM m JOIN acc ON {key} = acc.account_id"
    )


# --- concept roll-ups ----------------------------------------------------------


def _case(column: str, mapping: dict[str, str]) -> str:
    return "CASE " + column + "".join(f" WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


_FACT = f"""SELECT x.account_id, c.data_code_id AS analytic_concept_id, c.sender_application_id,
       c.commercial_product_type, c.commercial_subproduct_type,
       CAST(x.amount AS DECIMAL(17,2)) AS analytic_concept_amount, DATE '{ODATE}' AS cutoff_date
FROM every_level x JOIN cat c ON x.pk = c.primary_key_type"""


def _detail(rows: str, coded: str, operations: str) -> str:
    return f"""{ACCOUNTS}, {CATALOGUE}, {RATES}, {rows},
coded AS ({coded}),
grouped AS (SELECT account_id, k, sum(amount) AS amount, {operations} AS n FROM coded GROUP BY account_id, k),
detail AS (SELECT account_id, k || 'IMP' AS pk, CAST(amount AS DECIMAL(17,2)) AS amount FROM grouped
           UNION ALL SELECT account_id, k || 'OPE', CAST(n AS DECIMAL(17,2)) FROM grouped)"""


def _rollup(
    rows: str,
    coded: str,
    subtotals: dict[str, str],
    totals: dict[str, str],
    operations: str = "count(*)",
) -> str:
    return f"""WITH {_detail(rows, coded, operations)},
detail_cat AS (SELECT d.account_id, c.data_code_id, d.amount, d.pk FROM detail d JOIN cat c ON d.pk = c.primary_key_type),
sub AS (SELECT account_id, sum(amount) AS amount, {_case("data_code_id", subtotals)} AS pk
        FROM detail_cat GROUP BY account_id, data_code_id),
sub_cat AS (SELECT s.account_id, c.commercial_product_type, s.amount, s.pk FROM sub s JOIN cat c ON s.pk = c.primary_key_type),
tot AS (SELECT account_id, sum(amount) AS amount, {_case("commercial_product_type", totals)} AS pk
        FROM sub_cat GROUP BY account_id, commercial_product_type),
tot_cat AS (SELECT t.account_id, t.amount, t.pk FROM tot t JOIN cat c ON t.pk = c.primary_key_type),
every_level AS (SELECT account_id, pk, amount FROM detail_cat UNION ALL
                SELECT account_id, pk, amount FROM sub_cat UNION ALL SELECT account_id, pk, amount FROM tot_cat)
{_FACT}"""


_SIT_CODED = f"""SELECT dispersal_account_id AS account_id, 'SIT' || sender_application_id AS k,
       CAST({_times("total_transaction_amount")} AS DECIMAL(17,2)) AS amount
FROM ({_SIT}) m JOIN acc ON dispersal_account_id = acc.account_id
JOIN fx ON operation_currency_id = fx.currency_id AND sit_transaction_date = fx.load_date"""
_CIE_CODED = f"""SELECT credit_internal_account_id AS account_id, 'CIE' || transaction_channel_type AS k,
       CAST({_times("CAST(operation_amount AS DECIMAL(17,2))")} AS DECIMAL(17,2)) AS amount
FROM ({_CIE}) m JOIN acc ON credit_internal_account_id = acc.account_id
JOIN fx ON trim(m.currency_id) = fx.currency_id AND transaction_date = fx.load_date"""
_DIE_CODED = f"""SELECT agreement_dispersal_acct_id AS account_id,
       'DIE' || substr(movement_desc, 1, 2) || CASE WHEN channel_id IS NOT NULL AND trim(channel_id) <> ''
            THEN substr(channel_id, 1, 2) ELSE 'OT' END AS k, fee_amount AS amount
FROM ({_DIE}) m JOIN acc ON agreement_dispersal_acct_id = acc.account_id"""
_DOM_CODED = f"""SELECT source_account_id AS account_id,
       'DOM' || CASE WHEN source_channel_id IN ('O','M') THEN 'MAN' ELSE 'DIG' END || source_channel_id AS k,
       -debit_amount AS amount, issued_receipt_number
FROM ({_DEB}) m JOIN ({_EMI}) e ON m.issuing_id = e.issuing_id JOIN acc ON e.source_account_id = acc.account_id"""
_H2H_CODED = f"""SELECT primary_subject_id AS account_id, 'H2H' || substr(subservice_type, -4, 4) AS k,
       {_times("transaction_amount")} AS amount
FROM ({_H2H}) m JOIN acc ON primary_subject_id = acc.account_id
JOIN fx ON operation_currency_type = fx.currency_id AND transaction_date = fx.load_date"""
_NOM_CODED = f"""SELECT commerce_account_id AS account_id,
       'NOMNO' || CASE WHEN payroll_channel_id IS NULL THEN 'OT' WHEN payroll_channel_id = 'BANXICO' THEN 'BX'
                       ELSE substr(payroll_channel_id, 1, 2) END AS k, payroll_amount AS amount
FROM ({_NOM}) m JOIN acc ON commerce_account_id = acc.account_id"""


def _cheque_part(source: str, prefix: str, types: str, amount: str) -> str:
    return f"""SELECT credit_internal_account_id AS account_id, '{prefix}' || cie_transaction_type AS k,
       CAST({_times(amount)} AS DECIMAL(17,2)) AS amount
FROM {source} m JOIN acc ON trim(credit_internal_account_id) = acc.account_id
JOIN fx ON m.currency_id = fx.currency_id AND transfer_debit_date = fx.load_date
WHERE trim(cie_transaction_type) IN ({types})"""


_TIB_DEM = f"""WITH {ACCOUNTS}, {CATALOGUE}, {RATES}, {_with("cheques")}, chq AS ({_CHQ}), dep AS ({_DEP}),
coded AS ({" UNION ALL ".join([
    _cheque_part("chq", "TIBTIB", "'D','E','3'", "checks_tot_amount"),
    _cheque_part("chq", "TIBTIB", "'B','C'", "cash_tot_amount"),
    _cheque_part("dep", "TIBTIB", "'D','E','3','B','C'", "check_tot_amount"),
    _cheque_part("chq", "DEMDEM", "'5','6'", "checks_tot_amount"),
    _cheque_part("chq", "DEMDEM", "'4'", "cash_tot_amount"),
    _cheque_part("dep", "DEMDEM", "'4','5','6'", "check_tot_amount"),
])}),
grouped AS (SELECT account_id, k, sum(amount) AS amount, count(*) AS n FROM coded GROUP BY account_id, k),
detail AS (SELECT account_id, k || 'IMP' AS pk, CAST(amount AS DECIMAL(27,2)) AS amount FROM grouped
           UNION ALL SELECT account_id, k || 'OPE', CAST(n AS DECIMAL(27,2)) FROM grouped),
detail_cat AS (SELECT d.account_id, c.data_code_id, d.amount, d.pk FROM detail d JOIN cat c ON d.pk = c.primary_key_type),
sub AS (SELECT account_id, data_code_id, sum(amount) AS amount, {_case("data_code_id", f.CHEQUE_SUBTOTALS)} AS pk
        FROM detail_cat GROUP BY account_id, data_code_id),
tot_code AS (SELECT account_id, sum(amount) AS amount, {_case("data_code_id", f.CHEQUE_TOTALS)} AS pk
             FROM sub GROUP BY account_id, data_code_id),
tot AS (SELECT account_id, pk, sum(amount) AS amount FROM tot_code GROUP BY account_id, pk),
every_level AS (SELECT account_id, pk, amount FROM detail_cat UNION ALL
                SELECT account_id, pk, amount FROM sub UNION ALL SELECT account_id, pk, amount FROM tot)
{_FACT}"""

_B40_FACT = f"""WITH {ACCOUNTS}, {CATALOGUE}, {_with("general_movements")}, m AS ({_B40}),
joined AS (SELECT counterpart_id || folio_contract_id AS account, m.*, acc.commercial_product_type AS apr,
                  acc.commercial_subproduct_type AS asub, c.commercial_product_type AS product_cat,
                  c.commercial_subproduct_type AS subproduct_cat, c.data_code_id, c.sender_application_id, c.sign_type
           FROM m JOIN acc ON counterpart_id || folio_contract_id = acc.account_id
           JOIN cat c ON m.movement_key = c.primary_key_type WHERE c.data_code_id IS NOT NULL),
grouped AS (SELECT account, data_code_id, sender_application_id, product_cat, subproduct_cat,
                   sum(CASE WHEN sign_type = '+' THEN -transaction_amount ELSE transaction_amount END) AS amount
            FROM joined GROUP BY account, movement_key, load_date, transaction_date, transaction_desc, currency_id,
                   product_cat, subproduct_cat, data_code_id, sender_application_id, apr, asub, sign_type)
SELECT account AS account_id, data_code_id AS analytic_concept_id, sender_application_id,
       product_cat AS commercial_product_type, subproduct_cat AS commercial_subproduct_type,
       CAST(amount AS DECIMAL(17,2)) AS analytic_concept_amount, DATE '{ODATE}' AS cutoff_date
FROM grouped"""


def _commission_fact(name: str, body: str, account: str, key: str) -> str:
    return f"""WITH {ACCOUNTS}, {CATALOGUE}, {_with(name)}, m AS ({body})
SELECT commission_account_id AS account_id, c.data_code_id AS analytic_concept_id, c.sender_application_id,
       c.commercial_product_type, c.commercial_subproduct_type,
       CAST(sum(total_commission_tax_amount) AS DECIMAL(17,2)) AS analytic_concept_amount,
       DATE '{ODATE}' AS cutoff_date
FROM m JOIN acc ON {account} = acc.account_id JOIN cat c ON {key} = c.primary_key_type
WHERE c.bg_operation_id = 'SIC'
GROUP BY commission_account_id, c.data_code_id, c.sender_application_id, c.commercial_product_type,
         c.commercial_subproduct_type"""


_SIC_FACT = _commission_fact("commissions", _SIC, "commission_account_id", "concept_key")
_SI5_FACT = _commission_fact(
    "branch_commissions",
    _SI5,
    _PADDED,
    "'SICCOBR5' || CASE WHEN length(card_service_type) = 2 THEN card_service_type ELSE '0' || card_service_type END",
)

FAMILY_SQL = {
    "concept_sit": _rollup(_with("transfers"), _SIT_CODED, f.SIT_SUBTOTALS, f.SIT_TOTALS),
    "concept_cie": _rollup(_with("collections"), _CIE_CODED, f.CIE_SUBTOTALS, f.CIE_TOTALS),
    "concept_tib_dem": _TIB_DEM,
    "concept_die": _rollup(_with("dispersals"), _DIE_CODED, f.DIE_SUBTOTALS, f.DIE_TOTALS),
    "concept_dom": _rollup(
        _with("debits", "issuances"),
        _DOM_CODED,
        f.DOM_SUBTOTALS,
        f.DOM_TOTALS,
        "sum(issued_receipt_number)",
    ),
    "concept_h2h": _rollup(_with("host_to_host"), _H2H_CODED, f.H2H_SUBTOTALS, f.H2H_TOTALS),
    "concept_nom": _rollup(_with("payrolls"), _NOM_CODED, f.NOM_SUBTOTALS, f.NOM_TOTALS),
    "concept_b40w": _B40_FACT,
    "concept_sicoco": _SIC_FACT,
    "concept_sicoco5": _SI5_FACT,
}


def _stack(*names: str) -> str:
    parts = [f"SELECT * FROM ({ROLES['earlier_facts']}) AS earlier"]
    parts += [f"SELECT * FROM ({FAMILY_SQL[n]}) AS {n}" for n in names]
    return " UNION ALL ".join(parts)


_FIRST = _stack("concept_b40w", "concept_sicoco", "concept_sicoco5")
_ALL = _stack(*FAMILY_SQL)

# --- other jobs ----------------------------------------------------------------

_REQUESTS = f"""SELECT CAST(trim(request_id) AS INT) AS request_id,
       replace(trim(priority_name), chr(10), '') AS priority_name,
       CAST(trim(request_amount) AS DECIMAL(17,2)) AS request_amount,
       CAST(trim(request_date) AS DATE) AS request_date, trim(status_type) AS status_type,
       CAST(trim(load_date) AS DATE) AS load_date
FROM ({ROLES["raw_orders"]}) AS raw_rows"""
_BALANCES = f"""SELECT b.gl_date, b.gl_branch_id, b.manager_id, b.customer_id, b.contract_id, b.account_id,
       b.sender_application_id, b.commercial_product_type, b.commercial_subproduct_type, b.origin_currency_id,
       b.account_opening_date, b.current_contract_expiration_date, b.contract_duration_number,
       b.current_balance_amount, b.current_bal_local_curncy_amount, b.overdue_balance_amount,
       b.overdue_bal_local_curncy_amount, b.cutoff_date, b.avg_bal_orig_curncy_amount, b.total_average_balance_amount
FROM ({ROLES["balances"]}) b JOIN ({ROLES["branches"]}) r ON b.gl_branch_id = r.branch_id
WHERE b.gl_date = DATE '1998-03-31' AND r.cutoff_date = DATE '{ODATE}' AND r.banking_type IN ('9047', '9105')"""
_TAX = f"""{_with("customers", "known_customers")},
tax AS (SELECT DISTINCT customer_id, trim(rfc_id) || trim(homoclave_name) AS rfc_id_basic FROM customers_rows
        WHERE load_date = (SELECT max(load_date) FROM customers_rows WHERE load_date <= DATE '{ODATE}')),
known AS (SELECT k.customer_id, tax.rfc_id_basic FROM
          (SELECT DISTINCT customer_id FROM known_customers_rows WHERE cutoff_date =
             (SELECT max(cutoff_date) FROM known_customers_rows WHERE cutoff_date <= DATE '{ODATE}')) k
          LEFT JOIN tax ON k.customer_id = tax.customer_id),
shared AS (SELECT DISTINCT tax.customer_id, tax.rfc_id_basic FROM known JOIN tax ON known.rfc_id_basic = tax.rfc_id_basic)"""
_UNIVERSE = f"""WITH {_TAX}, {_with("contract_holders")},
added AS (SELECT s.* FROM shared s WHERE NOT EXISTS (SELECT 1 FROM known k
          WHERE k.customer_id = s.customer_id AND k.rfc_id_basic = s.rfc_id_basic)),
whole AS (SELECT * FROM known UNION ALL SELECT * FROM added)
SELECT w.customer_id, w.rfc_id_basic, trim(h.product_type) || trim(h.account_id) AS account, h.account_register_branch_id
FROM whole w JOIN contract_holders_rows h ON w.customer_id = h.customer_id
WHERE h.load_date = (SELECT max(load_date) FROM contract_holders_rows WHERE load_date <= DATE '{ODATE}')
  AND h.account_intervention_type = 'T' AND h.account_interventon_id = '01'"""


def _rule(rule: str, target: str, total: str, passed: str, low: str, accept: str = "100", critical: str = "true") -> str:
    """One report row; ``total`` and ``passed`` are SQL over the CTE ``t``."""
    return f"""SELECT '{rule}' AS rule, {target} AS target, total, passed, pct,
       CASE WHEN pct < {low} THEN 'KO' WHEN pct < 100 THEN 'WARN' ELSE 'OK' END AS status,
       {critical} AS critical, pct >= {accept} AS accepted
FROM (SELECT total, passed, CAST((passed * 1000000 // total) AS DECIMAL(18,4)) / 10000 AS pct
      FROM (SELECT {total} AS total, {passed} AS passed) a) b"""


def _report(*rules: str) -> str:
    body = " UNION ALL ".join(rules)
    return f"""SELECT rule, target, total, passed, CAST(pct AS DECIMAL(9,4)) AS pct, status, critical, accepted FROM ({body}) r"""


def _two_counts(other: str) -> tuple[str, str]:
    n = "(SELECT count(*) FROM t)"
    return f"greatest({n}, ({other}))", f"least({n}, ({other}))"


def _rows_ok(condition: str) -> tuple[str, str]:
    return "(SELECT count(*) FROM t)", f"(SELECT count(*) FROM t WHERE {condition})"


_N = "(SELECT count(*) FROM t)"
_RAW_COUNT = f"SELECT count(*) FROM ({ROLES['raw_orders']}) x WHERE load_date = '{ODATE}'"
_DQ = f"WITH t AS ({_REQUESTS}) " + _report(
    _rule("NotEmpty", "'*'", _N, _N, "100"),
    _rule("MatchesControlCount", "'control'", *_two_counts("SELECT count(*) FROM customer"), "100"),
    _rule("MatchesDatasetCount", "'dataset'", *_two_counts("SELECT count(*) FROM orders"), "100"),
    _rule("MatchesDatasetCount", f"'load_date = ''{ODATE}'''", *_two_counts(_RAW_COUNT), "100"),
    _rule("NotNull", "'request_id,load_date'", *_rows_ok("request_id IS NOT NULL AND load_date IS NOT NULL"), "100"),
    _rule("NotNull", "'status_type'", *_rows_ok("status_type IS NOT NULL"), "60", "50"),
    _rule("DateEquals", "'load_date'", *_rows_ok(f"load_date = DATE '{ODATE}'"), "100", critical="false"),
    _rule("MatchesPattern", "'status_type'", *_rows_ok("regexp_matches(status_type, '^[a-zA-Z]+$')"), "10"),
    _rule("MaxLength", "'priority_name'", *_rows_ok("coalesce(length(priority_name), 0) <= 8"), "100", critical="false"),
)
_DQ_SUBSET = f"WITH t AS (SELECT * FROM ({_REQUESTS}) q WHERE load_date = DATE '{ODATE}') " + _report(
    _rule("DateEquals", "'load_date'", *_rows_ok(f"load_date = DATE '{ODATE}'"), "100"),
    _rule("MatchesDatasetCount", f"'load_date = ''{ODATE}'''", *_two_counts(_RAW_COUNT), "100"),
    _rule(
        "NotNull",
        "'request_id,status_type'",
        *_rows_ok("request_id IS NOT NULL AND status_type IS NOT NULL"),
        "100",
        critical="false",
    ),
)
_DQ_LENGTH = "WITH t AS (SELECT * FROM documents) " + _report(
    *[
        _rule("MaxLength", f"'{c}'", *_rows_ok(f"{c} IS NULL OR length({c}) <= {n}"), "100")
        for c, n in {"text": 5000, "lang": 2, "source": 20}.items()
    ]
)
_MIXED = """SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%d/%m/%Y')
            WHEN o_orderstatus = 'F' THEN CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(month(o_orderdate) AS VARCHAR)
                                          || '/' || CAST(year(o_orderdate) AS VARCHAR) END AS visit_start_date,
       CASE WHEN o_orderpriority < '3' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(o_orderdate, '%d/%m/%Y') END AS visit_end_date
FROM orders"""
_DATE_PATTERN = r"'^\d{2}/\d{2}/\d{4}$'"


def _each_date(template: str) -> str:
    return f"WITH t AS ({_MIXED}) " + " UNION ALL ".join(
        template.replace("{c}", c) for c in ("visit_start_date", "visit_end_date")
    )


def _lenient(column: str) -> str:
    return (
        f"CASE WHEN regexp_matches({column}, {_DATE_PATTERN}) "
        f"THEN CAST(try_strptime({column}, '%d/%m/%Y') AS DATE) END"
    )


_SPACES = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_NORMAL = f"lower(regexp_replace(text, '^{_SPACES}+|{_SPACES}+\\z', '', 'g'))"
_LINES = """SELECT doc_id, CAST(unnest(range(len(parts))) AS INTEGER) AS position, unnest(parts) AS value
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents) s"""


# The edit distance here counts bytes.  The questions are plain ASCII, so one byte that stands in none of them
# can stand for any other character while distances are counted; the text itself stays as stored.
_TALK = "SELECT conv_id, turn, text, regexp_replace(text, '[^ -~]', chr(1), 'g') AS counted FROM conversations"


def _score(question: str) -> str:
    return f"""1.0::DOUBLE - CAST(levenshtein(counted, '{question}') AS DOUBLE)
       / CAST(greatest(length(text), length('{question}')) AS DOUBLE)"""


_EACH_SCORE = " UNION ALL ".join(
    f"SELECT conv_id, turn, text, '{q}' AS question, {_score(q)} AS score FROM t" for q in QUESTIONS
)


ORACLES: dict[str, str] = {
    **FAMILY_SQL,
    "latest_snapshot": f"""WITH {ACCOUNTS} SELECT account_id, commercial_product_type, commercial_subproduct_type,
       gl_branch_id, contract_status_type, cutoff_date FROM newest WHERE cutoff_date = top_date""",
    "latest_snapshot_open_accounts": f"WITH {ACCOUNTS} SELECT * FROM acc",
    "open_account_versions": f"WITH {ACCOUNTS} SELECT account_id, count(*) AS copies FROM acc GROUP BY account_id",
    "newest_issuances": f"WITH {_with('issuances')} {_EMI}",
    "month_bounds": """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
       last_day(CAST(o_orderdate AS DATE)) AS month_end, strftime(o_orderdate, '%d/%m/%Y') AS day_text, count(*) AS n
FROM orders GROUP BY 1, 2, 3""",
    "max_date_as_of": f"WITH {_with('transfers')} SELECT max(load_date) AS load_date FROM transfers_rows WHERE load_date <= DATE '{ODATE}'",
    "catalog_newest_cutoff": """WITH c AS (SELECT CAST(o_orderkey AS VARCHAR) AS primary_key_type,
  substr(o_orderpriority, 1, 1) AS bg_operation_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS data_code_id,
  CAST(date_trunc('year', o_orderdate) AS DATE) AS cutoff_date FROM orders)
SELECT * FROM c WHERE cutoff_date = (SELECT max(cutoff_date) FROM c) AND data_code_id IS NOT NULL AND bg_operation_id = '1'""",
    "month_window_late_arrivals": _reader("transfers", _SIT),
    "collections_reader": _reader("collections", _CIE),
    "signed_amount_currency_case": _reader("cheques", _CHQ),
    "deposits_recoded": _reader("cheques", _DEP),
    "dispersals_reader": _reader("dispersals", _DIE),
    "debit_movements_reader": _reader("debits", _DEB),
    "host_to_host_reader": _reader("host_to_host", _H2H),
    "payrolls_reader": _reader("payrolls", _NOM),
    "general_movements_reader": _reader("general_movements", _B40),
    "commissions_reader": _reader("commissions", _SIC),
    "branch_commissions_reader": _reader("branch_commissions", _SI5),
    "composed_key": """SELECT l_orderkey, l_linenumber, l_returnflag || l_linestatus AS plain,
       'K' || CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS nullable,
       substr(lpad(CAST(l_partkey AS VARCHAR), 6, '0'), 3, 4) AS middle,
       substr(CAST(l_suppkey AS VARCHAR), -4, 4) AS ending, trim('  ' || l_linestatus || ' ') AS trimmed
FROM lineitem""",
    "movement_account_join": _joined("transfers", _SIT, "m.dispersal_account_id"),
    "account_join_semi": _joined("transfers", _SIT, "m.dispersal_account_id", semi=True),
    "concatenated_key_join": _joined("general_movements", _B40, "counterpart_id || folio_contract_id"),
    "substring_key_join": _joined("commissions", _SIC, "commission_account_id"),
    "padded_key_join": _joined("branch_commissions", _SI5, _PADDED),
    "trimmed_key_join": _joined("cheques", _CHQ, "trim(credit_internal_account_id)"),
    "fx_lookup_daily": f"""WITH {RATES}, {_with("collections")}, m AS ({_CIE})
SELECT m.*, fx.rate AS exchange_rate,
       CAST({_times("CAST(operation_amount AS DECIMAL(17,2))")} AS DECIMAL(17,2)) AS local_amount
FROM m JOIN fx ON trim(m.currency_id) = fx.currency_id AND m.transaction_date = fx.load_date""",
    "fx_lookup_unmatched": f"""WITH {RATES}, {_with("host_to_host")}, m AS ({_H2H})
SELECT m.* FROM m WHERE NOT EXISTS (SELECT 1 FROM fx WHERE fx.currency_id = m.operation_currency_type
       AND fx.load_date = m.transaction_date)""",
    "fx_lookup_month_end": f"""WITH {_with("rates")} SELECT load_date, exchange_currency_min_amount, currency_id FROM rates_rows
WHERE entity_id = '0074' AND exchange_currency_type = 'M' AND currency_quote_type = 'S'
  AND outgoing_currency_id = 'MXP' AND load_date = DATE '{ODATE}'""",
    "catalogue_lookup": f"""WITH {CATALOGUE}, {_with("commissions")}, m AS ({_SIC})
SELECT m.*, c.data_code_id, c.sender_application_id, c.commercial_product_type, c.commercial_subproduct_type
FROM m JOIN cat c ON m.concept_key = c.primary_key_type WHERE c.bg_operation_id = 'SIC'""",
    "signed_catalogue_lookup": f"""WITH {CATALOGUE}, {_with("general_movements")}, m AS ({_B40})
SELECT m.*, c.data_code_id, c.sign_type, c.commercial_product_type AS product_cat,
       CASE WHEN c.sign_type = '+' THEN -m.transaction_amount ELSE m.transaction_amount END AS signed_amount
FROM m JOIN cat c ON m.movement_key = c.primary_key_type WHERE c.data_code_id IS NOT NULL""",
    "issuance_join": f"""WITH {_with("debits", "issuances")} SELECT m.*, e.source_account_id, e.source_channel_id
FROM ({_DEB}) m JOIN ({_EMI}) e ON m.issuing_id = e.issuing_id""",
    "detail_imp_ope": f"""WITH {_detail(_with("transfers"), _SIT_CODED, "count(*)")}
SELECT account_id, pk AS primary_key_type, amount AS analytic_concept_amount FROM detail""",
    "profit_first_part": _FIRST,
    "concept_all": _ALL,
    "concept_all_staged": _ALL,
    "balance_export": _BALANCES,
    "csv_export_roundtrip": _BALANCES,
    "customer_universe": _UNIVERSE,
    "customers_sharing_tax_id": f"WITH {_TAX} SELECT customer_id, rfc_id_basic FROM shared",
    "ingest_raw_to_master": _REQUESTS,
    "ingest_one_load": f"SELECT * FROM ({_REQUESTS}) q WHERE load_date = DATE '{ODATE}'",
    "ingest_landing_to_raw": f"""SELECT request_id, priority_name, request_amount, request_date, status_type,
       '{ODATE}' AS load_date FROM ({ROLES["raw_orders"]}) r""",
    "sink_append_roundtrip": _REQUESTS,
    "sink_reprocess_roundtrip": f"""SELECT request_id, priority_name,
       CAST(CASE WHEN load_date = DATE '{ODATE}' THEN request_amount * 2 ELSE request_amount END AS DECIMAL(17,2)) AS request_amount,
       request_date, status_type, load_date FROM ({_REQUESTS}) q""",
    "conform_fact": ROLES["earlier_facts"],
    "dq_report": _DQ,
    "dq_report_subset": _DQ_SUBSET,
    "dq_refusals": f"""WITH t AS ({_REQUESTS})
SELECT t.*, 'NotNull(request_id,status_type)' AS refused_by FROM t WHERE request_id IS NULL OR status_type IS NULL
UNION ALL SELECT t.*, 'MaxLength(priority_name)' FROM t WHERE length(priority_name) > 8""",
    "dq_acceptance": f"""SELECT 'not_empty' AS "check", count(*) > 0 AS ok FROM orders
UNION ALL SELECT 'same_records', (SELECT count(*) FROM ({_REQUESTS}) a) = (SELECT count(*) FROM ({ROLES["raw_orders"]}) b)
UNION ALL SELECT 'column_count', (SELECT count(*) FROM (DESCRIBE ({_REQUESTS}))) = (SELECT count(*) FROM (DESCRIBE ({ROLES["raw_orders"]})))""",
    "dq_max_length": _DQ_LENGTH,
    "dq_files_per_partition": f"""SELECT 'load_date=' || CAST(load_date AS VARCHAR) AS directory,
       count(*) > 0 AS has_files, sum(octet_length(CAST(q AS VARCHAR)::BLOB)) > 0 AS has_bytes, count(DISTINCT load_date) < 100 AS ok
FROM ({_REQUESTS}) q GROUP BY load_date""",
    "profile_dates": _each_date(
        f"""SELECT '{{c}}' AS column_name, count(*) AS rows, count(*) FILTER ({{c}} IS NULL) AS nulls,
       count(*) FILTER (regexp_matches({{c}}, {_DATE_PATTERN})) AS matching,
       count(*) FILTER ({{c}} IS NOT NULL AND NOT regexp_matches({{c}}, {_DATE_PATTERN})) AS not_matching FROM t"""
    ),
    "profile_dates_off_format": _each_date(
        f"""SELECT '{{c}}' AS column_name, {{c}} AS value, count(*) AS n FROM t
WHERE {{c}} IS NOT NULL AND NOT regexp_matches({{c}}, {_DATE_PATTERN}) GROUP BY 2"""
    ),
    "profile_null_positions": _each_date(
        "SELECT '{c}' AS column_name, o_orderkey AS row_id FROM t WHERE {c} IS NULL"
    ),
    "parse_dates_lenient": f"""WITH t AS ({_MIXED}) SELECT o_orderkey, {_lenient("visit_start_date")} AS visit_start_date,
       {_lenient("visit_end_date")} AS visit_end_date FROM t""",
    "parse_dates_strict": """SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS visit_start_date FROM orders""",
    "profile_nulls": f"WITH t AS ({_REQUESTS}) "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM t"
        for c in "request_id priority_name request_amount request_date status_type load_date".split()
    ),
    "profile_required": f"""WITH t AS ({_REQUESTS})
SELECT 'request_id' AS column_name, true AS present, count(*) FILTER (request_id IS NULL) AS nulls FROM t
UNION ALL SELECT 'status_type', true, count(*) FILTER (status_type IS NULL) FROM t
UNION ALL SELECT 'absent_column', false, NULL""",
    "null_rows_filled": f"""SELECT request_id, priority_name, request_amount, request_date, 'UNKNOWN' AS status_type, load_date
FROM ({_REQUESTS}) q WHERE status_type IS NULL""",
    "distinct_values_by_field": """SELECT lang AS field, source AS value, CAST(length(source) AS INTEGER) AS length, count(*) AS n
FROM documents GROUP BY lang, source""",
    "value_digest": " UNION ALL ".join(
        f"""SELECT '{c}' AS field, count(DISTINCT {c}) AS distinct_values,
       CAST(max(length(CAST({c} AS VARCHAR))) AS INTEGER) AS max_length FROM orders"""
        for c in ("o_orderstatus", "o_orderpriority", "o_custkey")
    ),
    "clean_chain": """SELECT CAST(o_orderkey AS VARCHAR) AS visit_id, CAST(o_totalprice AS DECIMAL(17,2)) AS visit_amount,
       substr(o_orderpriority || ' / ' || o_orderstatus || ' / ' || o_orderpriority || ' / ' || o_orderpriority, 1, 25)
         AS visit_person_name FROM orders""",
    "text_records_split": rf"""WITH l AS ({_LINES}),
h AS (SELECT doc_id, position, string_split(value, ',') AS halves FROM l),
p AS (SELECT *, string_split_regex(halves[1], '[.]+') AS pieces FROM h WHERE len(halves) = 2)
SELECT doc_id, position, CASE WHEN len(pieces) = 2 THEN pieces[1] ELSE halves[1] END AS questions,
       CASE WHEN len(pieces) = 2 THEN pieces[2] ELSE '' END AS options, halves[2] AS answers FROM p""",
    "text_records_quarantine": f"WITH l AS ({_LINES}) SELECT * FROM l WHERE len(string_split(value, ',')) <> 2",
    "text_dedupe": f"""SELECT doc_id, text, source FROM (
SELECT doc_id, text, source, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS place
FROM (SELECT doc_id, {_NORMAL} AS text, source FROM documents) n) d WHERE place = 1""",
    "text_topk_levenshtein": f"""WITH t AS ({_TALK}) SELECT conv_id, turn, text, {_score(QUESTION)} AS score
FROM t ORDER BY score DESC, conv_id, turn LIMIT 10""",
    "text_topk_each_question": f"""WITH t AS ({_TALK}), s AS ({_EACH_SCORE})
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, conv_id, turn) AS INTEGER) AS place FROM s) r
WHERE place <= 5""",
    "text_blocks_split": """SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS questions, p_type || chr(10) || p_brand AS options,
       '' AS answers FROM part WHERE p_size <= 40""",
    "text_blocks_quarantine": "SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS question FROM part WHERE p_size > 40",
    "text_marked_split": """SELECT p_name || chr(10) || CAST(p_partkey AS VARCHAR) AS questions, '' AS options, p_type AS answers
FROM part WHERE p_size > 10""",
    "text_marked_quarantine": """SELECT 'Question|' || p_name || '|' || CAST(p_partkey AS VARCHAR) AS record
FROM part WHERE p_size <= 10""",
    "null_positions_in_files": """WITH o AS (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id FROM orders)
SELECT 'status_type' AS column_name, row_id FROM o WHERE o_orderstatus = 'P' OR o_orderstatus IS NULL""",
    "text_topk_indexed": f"""WITH t AS ({_TALK}) SELECT conv_id, turn, text, {_score(QUESTION)} AS score
FROM t ORDER BY score DESC, conv_id, turn LIMIT 10""",
    "text_topk_each_indexed": f"""WITH t AS ({_TALK}), s AS ({_EACH_SCORE})
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY question ORDER BY score DESC, conv_id, turn) AS INTEGER) AS place FROM s) r
WHERE place <= 5""",
    "text_index_effort": f"""SELECT q.question, (SELECT count(*) FROM conversations) AS rows, TRUE AS spared
FROM (VALUES {", ".join(f"('{q}')" for q in QUESTIONS)}) AS q(question)""",
    "sink_overwrite_roundtrip": _REQUESTS,
    "csv_to_parquet_roundtrip": _REQUESTS,
    "spark_json_schema_roundtrip": _REQUESTS,
    "partition_presence": f"""SELECT v.value, EXISTS (SELECT 1 FROM ({_REQUESTS}) q WHERE q.load_date = v.value) AS present
FROM (VALUES (DATE '{ODATE}'), (DATE '1990-01-31'), (DATE '2000-02-29')) AS v(value)""",
    "csv_codes_roundtrip": """SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS code,
       CAST(o_totalprice AS DECIMAL(17,2)) AS amount, o_orderkey AS order_number FROM orders""",
    "padded_csv_roundtrip": f"SELECT request_id, status_type, load_date FROM ({_REQUESTS}) q",
    "control_count_roundtrip": "SELECT count(*) AS expected FROM orders",
    "record_file_split": """WITH r AS (SELECT p_name || ' ' || CAST(p_partkey AS VARCHAR) AS head, p_brand, p_type, p_size FROM part)
SELECT head AS questions, CASE WHEN p_size > 30 THEN p_brand ELSE '' END AS options, p_type AS answers
FROM r WHERE p_size > 10""",
    "merged_files_deduped": """SELECT file_no, p_partkey, name FROM (
SELECT *, row_number() OVER (PARTITION BY name ORDER BY file_no, p_partkey) AS place
FROM (SELECT CASE WHEN p_size <= 25 THEN 1 ELSE 2 END AS file_no, p_partkey, lower(p_name) AS name FROM part) n) d
WHERE place = 1""",
}
# The same rows, found another way.
ORACLES["max_date_from_partitions"] = f"""WITH {_with('transfers')}
SELECT CAST(max(date_trunc('month', load_date)) AS DATE) AS load_date FROM transfers_rows WHERE date_trunc('month', load_date) <= DATE '{ODATE}'"""
ORACLES["catalogue_from_newest_partition"] = ORACLES["catalog_newest_cutoff"]
ORACLES["partition_presence_listed"] = f"SELECT CAST(value AS VARCHAR) AS value, present FROM ({ORACLES['partition_presence']}) p"
ORACLES["concept_restated"] = " UNION ALL ".join(f"SELECT * FROM ({FAMILY_SQL[n]}) AS {n}" for n in ("concept_sit", "concept_cie", "concept_tib_dem"))
ORACLES["dq_report_from_state"] = ORACLES["dq_report"]
ORACLES["preview_rows"] = "SELECT o_orderkey, o_orderstatus, o_custkey FROM orders ORDER BY o_orderkey LIMIT 4"
ORACLES["parse_dates_in_words"] = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date FROM orders"
