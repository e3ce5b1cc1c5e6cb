from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators.customers import customer_universe
from ledgerloom.plans import families
from ledgerloom.sources import movements as read

ODATE, DATEM = "2022-01-31", "2022-02-05"
IN, LATE, TOO_LATE = date(2022, 1, 5), date(2022, 2, 4), date(2022, 2, 6)


def _cheques(spark, *rows):
    return spark.createDataFrame(
        [
            (status, kind, code, reason, load, day, "acc", Decimal("2.00"), Decimal("3.00"), Decimal("4.00"))
            for status, kind, code, reason, load, day in rows
        ],
        "check_status_id string, cie_transaction_type string, contract_currency_id string, "
        "return_reason_type string, load_date date, transfer_debit_date date, "
        "credit_internal_account_id string, cash_payment_amount decimal(17,2), "
        "dpst_file_checks_tot_amount decimal(17,2), check_amount decimal(17,2)",
    )


def test_two_date_axes(spark, rows):
    stored = _cheques(
        spark,
        ("PR", "B", "1", "00", IN, IN),
        ("PR", "C", "1", "00", LATE, IN),
        ("PR", "D", "1", "00", TOO_LATE, IN),
        ("PR", "E", "1", "00", LATE, LATE),
        ("PR", "3", "1", "00", date(2021, 12, 31), IN),
    )
    assert rows(read.cheques(stored, ODATE, DATEM), "cie_transaction_type") == [("B",), ("C",)]


def test_cheques_are_trimmed_signed_and_given_a_currency(spark, rows):
    stored = _cheques(
        spark,
        (" PR ", " B ", "25", "00", IN, IN),
        ("PR", "5", "75", "07", IN, IN),
        ("PR", "6", "words", None, IN, IN),
        ("PR", "1", "25", "00", IN, IN),
        ("RE", "B", "25", "00", IN, IN),
    )
    got = rows(read.cheques(stored, ODATE, DATEM), "cie_transaction_type", "currency_id", "cash_tot_amount")
    assert got == [
        (" B ", "USD", Decimal("2.00")),
        ("5", "USD", Decimal("-2.00")),
        ("6", "MXP", Decimal("-2.00")),
    ]


def test_every_deposit_becomes_type_four(spark):
    stored = _cheques(spark, ("PR", "B", "25", "00", IN, IN), ("PR", "3", "25", "00", IN, IN))
    kinds = {r["cie_transaction_type"] for r in read.cheque_deposits(stored, ODATE, DATEM).collect()}
    assert kinds == {"4"}


def test_host_to_host_trims_and_drops_zero_and_null(spark, rows):
    stored = spark.createDataFrame(
        [
            (" 1 ", " USD", " T008 ", IN, Decimal("1.00")),
            ("2", "USD", "T008", IN, Decimal("0.00")),
            ("3", "USD", "T008", IN, None),
        ],
        "primary_subject_id string, operation_currency_type string, subservice_type string, "
        "transaction_date date, transaction_amount decimal(17,2)",
    )
    assert rows(
        read.host_to_host(stored, ODATE), "primary_subject_id", "operation_currency_type", "subservice_type"
    ) == [("1", "USD", "T008")]


def test_commission_readers_cut_account_and_service(spark, rows):
    stored = spark.createDataFrame(
        [(" MX0000000012X", "CARD-XY0199", date(2022, 1, 31), Decimal("1.00")),
         ("MX0000000013", "CARD-XY02", date(2022, 1, 30), Decimal("1.00"))],
        "commission_account_id string, card_service_type string, cutoff_date date, "
        "total_commission_tax_amount decimal(17,2)",
    )
    assert rows(read.commissions(stored, ODATE), "commission_account_id", "concept_key") == [
        ("X0000000012"[:10], "SICCOBRS01")
    ]
    assert rows(read.branch_commissions(stored, ODATE), "commission_account_id") == [("0000000012",)]


def test_rate_readers(spark, rows):
    base = ("0074", "USD", "MXP", "D", "S", Decimal("20.000000"), IN)
    stored = spark.createDataFrame(
        [
            base,
            ("0001", *base[1:]),
            (*base[:2], "EUR", *base[3:]),
            (*base[:3], "M", "S", Decimal("21.000000"), date(2022, 1, 31)),
            (*base[:4], "B", *base[5:]),
            (*base[:6], LATE),
        ],
        "entity_id string, currency_id string, outgoing_currency_id string, exchange_currency_type string, "
        "currency_quote_type string, exchange_currency_min_amount decimal(17,6), load_date date",
    )
    assert rows(read.daily_rates(stored, ODATE), "exchange_currency_min_amount") == [(Decimal("20.000000"),)]
    assert rows(read.month_end_rates(stored, ODATE), "exchange_currency_min_amount") == [(Decimal("21.000000"),)]


def test_keys_of_payrolls_dispersals_and_services(spark):
    nom, family = families.nom(
        spark.createDataFrame([(None,), ("BANXICO",), ("INTERNET",)], "payroll_channel_id string")
    )
    assert [r[0] for r in nom.select(family.key).collect()] == ["NOMNOOT", "NOMNOBX", "NOMNOIN"]
    die, family = families.die(
        spark.createDataFrame(
            [("PAGO", None), ("PAGO", "  "), ("CR", "INET"), (None, "X")],
            "movement_desc string, channel_id string",
        )
    )
    assert [r[0] for r in die.select(family.key).collect()] == ["DIEPAOT", "DIEPAOT", "DIECRIN", None]
    rates = spark.createDataFrame(
        [("MXP", IN, Decimal("1.000000"))],
        "currency_id string, load_date date, exchange_currency_min_amount decimal(17,6)",
    )
    h2h, family = families.h2h(
        spark.createDataFrame(
            [("MXP", IN, "SRVT008"), ("MXP", IN, "T8")],
            "operation_currency_type string, transaction_date date, subservice_type string",
        ),
        rates,
    )
    assert sorted(r[0] for r in h2h.select(family.key).collect()) == ["H2HT008", "H2HT8"]


def test_customer_universe(spark, rows):
    customers = spark.createDataFrame(
        [
            ("c1", "AAA ", " 1", IN), ("c2", "AAA", "1", IN), ("c3", "BBB", "2", IN),
            ("c4", "AAA", "1", date(2021, 1, 1)), ("c5", None, "1", IN),
        ],
        "customer_id string, rfc_id string, homoclave_name string, load_date date",
    )
    known = spark.createDataFrame(
        [("c1", IN), ("c1", IN), ("c5", IN), ("c9", IN), ("c3", date(2021, 1, 1))],
        "customer_id string, cutoff_date date",
    )
    contracts = spark.createDataFrame(
        [
            ("c1", " P", "1 ", "b", "T", "01", IN), ("c2", "P", "2", "b", "T", "01", IN),
            ("c3", "P", "3", "b", "T", "01", IN), ("c9", "P", "9", "b", "T", "01", IN),
            ("c5", "P", "5", "b", "T", "02", IN), ("c1", "P", "6", "b", "C", "01", IN),
        ],
        "customer_id string, product_type string, account_id string, account_register_branch_id string, "
        "account_intervention_type string, account_interventon_id string, load_date date",
    )
    out = customer_universe(customers, known, contracts, ODATE)
    assert rows(out, "customer_id", "rfc_id_basic", "account") == [
        ("c1", "AAA1", "P1"), ("c2", "AAA1", "P2"), ("c9", None, "P9"),
    ]
    assert out.where(F.col("account_register_branch_id") != "b").count() == 0
