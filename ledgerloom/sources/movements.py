"""Business readers: the rows and columns each movement table contributes.

Each reader takes the stored table (``spark.read.parquet(path)``) and keeps its
filters and columns next to the scan, so Catalyst pushes both into it.  Movements
have two time axes: the business date, bounded by the as-of date ``odate``, and
the arrival date ``load_date``, bounded by the later date ``datem``, so that rows
of the month which arrived after ``odate`` still count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date, month_start, within
from ledgerloom.functions.keys import currency_from_code, flipped_unless, joined_key

# Codes of the source systems.
DONE = "CO"
PRESENTED = "PR"
CHEQUE_TYPES = ("B", "C", "D", "E", "3", "4", "5", "6")
NOT_RETURNED = "00"
DISPERSAL_PAID = "P001"
DEBIT_COLLECTED = "RO"
RATE_ENTITY = "0074"
LOCAL_CURRENCY = "MXP"
SPOT_QUOTE = "S"
DAILY_RATE = "D"
MONTHLY_RATE = "M"

# The columns each reader selects, their names and the codes in its filters.


def _arrived(odate: str, datem: str) -> Column:
    return within("load_date", month_start(odate), datem)


def _in_month(column: str, odate: str) -> Column:
    return within(column, month_start(odate), odate)


def _non_zero(column: str) -> Column:
    return F.col(column) != 0


def transfers(table: DataFrame, odate: str, datem: str) -> DataFrame:
    """Completed transfers of the month (SIT)."""
    return table.where(
        (F.col("operation_status_type") == DONE)
        & _arrived(odate, datem)
        & _in_month("sit_transaction_date", odate)
    ).select(
        "agreement_id",
        "sit_transaction_date",
        "operation_currency_id",
        "total_transaction_amount",
        "sender_application_id",
        "operation_status_type",
        "dispersal_account_id",
    )


def collections_by_agreement(table: DataFrame, odate: str, datem: str) -> DataFrame:
    """Completed collections of the month (CIE)."""
    return table.where(
        (F.col("srce_appl_operation_status_type") == DONE)
        & _arrived(odate, datem)
        & _in_month("transaction_date", odate)
    ).select(
        "agreement_id",
        "transaction_date",
        "value_date",
        "currency_id",
        "operation_amount",
        "credit_internal_account_id",
        "srce_appl_operation_status_type",
        "transaction_channel_type",
    )


def _presented(table: DataFrame, odate: str, datem: str) -> DataFrame:
    return table.where(
        _arrived(odate, datem)
        & _in_month("transfer_debit_date", odate)
        & (F.trim("check_status_id") == PRESENTED)
        & F.trim("cie_transaction_type").isin(*CHEQUE_TYPES)
    )


def _signed(column: str) -> Column:
    return flipped_unless(F.col("return_reason_type") == NOT_RETURNED, column)


def cheques(table: DataFrame, odate: str, datem: str) -> DataFrame:
    """Presented cheques: currency from the contract code, returned ones negative."""
    return _presented(table, odate, datem).select(
        "transfer_debit_date",
        currency_from_code("contract_currency_id").alias("currency_id"),
        "credit_internal_account_id",
        "cie_transaction_type",
        "check_status_id",
        _signed("cash_payment_amount").alias("cash_tot_amount"),
        _signed("dpst_file_checks_tot_amount").alias("checks_tot_amount"),
    )


def cheque_deposits(table: DataFrame, odate: str, datem: str) -> DataFrame:
    """Presented deposits, as :func:`cheques`.

    The type filter has already dropped type ``1``, so the recoding below makes
    every row type ``4``; it is kept because the results must stay the same.
    """
    recoded = F.when(F.col("cie_transaction_type") == "1", F.lit("3")).otherwise(F.lit("4"))
    return _presented(table, odate, datem).select(
        "transfer_debit_date",
        currency_from_code("contract_currency_id").alias("currency_id"),
        "credit_internal_account_id",
        recoded.alias("cie_transaction_type"),
        "check_status_id",
        _signed("check_amount").alias("check_tot_amount"),
    )


def dispersals(table: DataFrame, odate: str) -> DataFrame:
    """Paid dispersals with a fee (DIE)."""
    return table.where(
        _non_zero("fee_amount")
        & (F.col("transaction_status_type") == DISPERSAL_PAID)
        & _in_month("value_date", odate)
    ).select(
        "movement_desc",
        "currency_id",
        "fee_amount",
        "transaction_status_type",
        "value_date",
        "agreement_dispersal_acct_id",
        "channel_id",
    )


def debit_issuances(table: DataFrame, odate: str) -> DataFrame:
    """Direct-debit issuances loaded in the month; every version.

    :func:`ledgerloom.operators.snapshots.newest_versions` picks the newest ones.
    """
    return table.where(_in_month("load_date", odate)).select(
        "issuing_id", "source_account_id", "source_channel_id", "load_date"
    )


def debit_movements(table: DataFrame, odate: str) -> DataFrame:
    """Collected direct debits (DOM)."""
    return table.where(
        _in_month("auto_payments_clct_proc_date", odate)
        & (F.col("collecting_mark_type") == DEBIT_COLLECTED)
        & _non_zero("debit_amount")
    ).select(
        "issuing_id",
        "debit_amount",
        "issued_receipt_number",
        "collecting_mark_type",
        "auto_payments_clct_proc_date",
    )


def host_to_host(table: DataFrame, odate: str) -> DataFrame:
    """Host-to-host movements, their codes trimmed (H2H)."""
    return table.where(
        _in_month("transaction_date", odate) & _non_zero("transaction_amount")
    ).select(
        F.trim("primary_subject_id").alias("primary_subject_id"),
        F.trim("operation_currency_type").alias("operation_currency_type"),
        "transaction_amount",
        F.trim("subservice_type").alias("subservice_type"),
        "transaction_date",
    )


def payrolls(table: DataFrame, odate: str) -> DataFrame:
    """Payroll deposits (NOM)."""
    return table.where(
        _in_month("payroll_customer_deposit_date", odate) & _non_zero("payroll_amount")
    ).select("commerce_account_id", "payroll_amount", "payroll_channel_id")


def general_movements(table: DataFrame, odate: str) -> DataFrame:
    """General movements with their catalogue key (B40W).

    The arrival bound "newest load date up to ``odate``" selects exactly the rows
    with ``load_date <= odate``, so no maximum has to be computed first.
    """
    return table.where(
        _in_month("load_date", odate)
        & _in_month("transaction_date", odate)
        & F.col("transaction_amount").isNotNull()
        & _non_zero("transaction_amount")
    ).select(
        joined_key("bg_operation_id", "transaction_id").alias("movement_key"),
        "load_date",
        "counterpart_id",
        "folio_contract_id",
        "transaction_date",
        "transaction_id",
        "transaction_desc",
        "currency_id",
        "transaction_amount",
    )


def _charged(table: DataFrame, odate: str) -> DataFrame:
    return table.where(
        (F.col("cutoff_date") == as_date(odate)) & _non_zero("total_commission_tax_amount")
    )


def commissions(table: DataFrame, odate: str) -> DataFrame:
    """Commissions of the cutoff, keyed by two characters of the service (SICOCO)."""
    service = F.substring("card_service_type", 8, 2)
    return _charged(table, odate).select(
        F.substring("commission_account_id", 3, 10).alias("commission_account_id"),
        "card_service_type",
        "total_commission_tax_amount",
        joined_key(F.lit("SICCOBRS"), service).alias("concept_key"),
    )


def branch_commissions(table: DataFrame, odate: str) -> DataFrame:
    """Commissions of the cutoff from the second source (SICOCO5)."""
    return _charged(table, odate).select(
        F.substring(F.trim("commission_account_id"), 3, 10).alias("commission_account_id"),
        "card_service_type",
        "total_commission_tax_amount",
    )


def _rates(table: DataFrame, kind: str, entity: str, local: str) -> DataFrame:
    return table.where(
        (F.col("entity_id") == entity)
        & (F.col("exchange_currency_type") == kind)
        & (F.col("currency_quote_type") == SPOT_QUOTE)
        & (F.col("outgoing_currency_id") == local)
    )


def daily_rates(table: DataFrame, odate: str, entity: str = RATE_ENTITY, local: str = LOCAL_CURRENCY) -> DataFrame:
    """Daily rates into the local currency, month start to ``odate``."""
    return (
        _rates(table, DAILY_RATE, entity, local)
        .where(_in_month("load_date", odate))
        .select("load_date", "exchange_currency_min_amount", "currency_id")
    )


def month_end_rates(table: DataFrame, odate: str, entity: str = RATE_ENTITY, local: str = LOCAL_CURRENCY) -> DataFrame:
    """Monthly rates into the local currency dated ``odate``."""
    return (
        _rates(table, MONTHLY_RATE, entity, local)
        .where(F.col("load_date") == as_date(odate))
        .select("load_date", "exchange_currency_min_amount", "currency_id")
    )
