"""The concept families: how each kind of movement is keyed, valued and rolled up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import joined_key, money
from ledgerloom.operators.concepts import ConceptFamily
from ledgerloom.operators.lookups import convert_currency
from ledgerloom.operators.snapshots import newest_copies, newest_versions

# Concept codes and keys of each family, from detail code to subtotal
# key and from product (or detail code) to total key.
SIT_SUBTOTALS = {
    "4110": "SITTDIGIMP",
    "6110": "SITTDIGOPE",
    "4130": "SITVTOTIMP",
    "6130": "SITVTOTOPE",
}
SIT_TOTALS = {"41": "SITTOTLIMP", "61": "SITTOTLOPE"}
CIE_SUBTOTALS = {
    "3210": "CIETDIGIMP",
    "5210": "CIETDIGOPE",
    "3230": "CIEVTOTIMP",
    "5230": "CIEVTOTOPE",
}
CIE_TOTALS = {"32": "CIETOTLIMP", "52": "CIETOTLOPE"}
CHEQUE_SUBTOTALS = {
    "3310": "DEMTEFEIMP",
    "3330": "DEMTCHQIMP",
    "3410": "TIBTEFEIMP",
    "3430": "TIBTCHQIMP",
    "5310": "DEMTEFEOPE",
    "5330": "DEMTCHQOPE",
    "5410": "TIBTEFEOPE",
    "5430": "TIBTCHQOPE",
}
CHEQUE_TOTALS = {
    "3310": "DEMTOTLIMP",
    "3330": "DEMTOTLIMP",
    "3410": "TIBTOTLIMP",
    "3430": "TIBTOTLIMP",
    "5310": "DEMTOTLOPE",
    "5330": "DEMTOTLOPE",
    "5410": "TIBTOTLOPE",
    "5430": "TIBTOTLOPE",
}
DIE_SUBTOTALS = {
    "4210": "DIEPAGLIMP",
    "6210": "DIEPAGLOPE",
    "4230": "DIECREDIMP",
    "6230": "DIECREDOPE",
}
DIE_TOTALS = {"42": "DIETDIEIMP", "62": "DIETDIEOPE"}
DOM_SUBTOTALS = {
    "3610": "DOMDIGLIMP",
    "5610": "DOMDIGLOPE",
    "3620": "DOMMANUIMP",
    "5620": "DOMMANUOPE",
}
DOM_TOTALS = {"36": "DOMTDOMIMP", "56": "DOMTDOMOPE"}
H2H_SUBTOTALS = {
    "3710": "H2HT008IMP",
    "5710": "H2HT008OPE",
    "3730": "H2HT009IMP",
    "5730": "H2HT009OPE",
}
H2H_TOTALS = {"37": "H2HTH2HIMP", "57": "H2HTH2HOPE"}
NOM_SUBTOTALS = {
    "4310": "NOMNOMDIMP",
    "6310": "NOMNOMDOPE",
    "4330": "NOMNOMAIMP",
    "6330": "NOMNOMAOPE",
}
NOM_TOTALS = {"43": "NOMNOMTIMP", "63": "NOMNOMTOPE"}
MANUAL_CHANNELS = ("O", "M")
CENTRAL_BANK = "BANXICO"
# Which amount of a cheque counts, by type, for each prefix.
TIB_BY_CHEQUE = ("D", "E", "3")
TIB_BY_CASH = ("B", "C")
DEM_BY_CHEQUE = ("5", "6")
DEM_BY_CASH = ("4",)
TIB_DEPOSITS = ("D", "E", "3", "B", "C")
DEM_DEPOSITS = ("4", "5", "6")

Source = tuple[DataFrame, ConceptFamily]


def sit(movements: DataFrame, rates: DataFrame) -> Source:
    """Transfers by sending application; each row is rounded after conversion."""
    family = ConceptFamily(
        name="SIT",
        account="dispersal_account_id",
        key=joined_key(F.lit("SIT"), "sender_application_id"),
        amount=F.col("total_transaction_amount") * F.col("exchange_rate"),
        round_rows=True,
        subtotals=SIT_SUBTOTALS,
        totals=SIT_TOTALS,
    )
    valued = convert_currency(
        movements, rates, "operation_currency_id", "sit_transaction_date"
    )
    return valued, family


def cie(movements: DataFrame, rates: DataFrame) -> Source:
    """Collections by channel; the amount is rounded before and after conversion."""
    family = ConceptFamily(
        name="CIE",
        account="credit_internal_account_id",
        key=joined_key(F.lit("CIE"), "transaction_channel_type"),
        amount=money("operation_amount") * F.col("exchange_rate"),
        round_rows=True,
        subtotals=CIE_SUBTOTALS,
        totals=CIE_TOTALS,
    )
    valued = convert_currency(
        movements, rates, "currency_id", "transaction_date", trim_currency=True
    )
    return valued, family


def _cheque_case(kind: Column, choices: list[tuple[str, tuple[str, ...], Column]]) -> Column:
    """``(prefix, amount)`` of the first choice whose types hold ``kind``."""

    def pair(prefix: str, amount: Column) -> Column:
        return F.struct(F.lit(prefix).alias("prefix"), amount.alias("value"))

    first, *rest = choices
    start = F.when(kind.isin(*first[1]), pair(first[0], first[2]))
    return reduce(lambda acc, c: acc.when(kind.isin(*c[1]), pair(c[0], c[2])), rest, start)


def tib_dem(cheques: DataFrame, deposits: DataFrame, rates: DataFrame) -> Source:
    """Cheques and deposits.  Each type belongs to one prefix and counts one amount.

    The filter trims the type but the key keeps it as it is, so a padded type finds
    no concept.  The account is found by its trimmed number and kept untrimmed.
    """
    kind = F.trim("cie_transaction_type")
    of_cheques = [
        ("TIBTIB", TIB_BY_CHEQUE, F.col("checks_tot_amount")),
        ("TIBTIB", TIB_BY_CASH, F.col("cash_tot_amount")),
        ("DEMDEM", DEM_BY_CHEQUE, F.col("checks_tot_amount")),
        ("DEMDEM", DEM_BY_CASH, F.col("cash_tot_amount")),
    ]
    of_deposits = [
        ("TIBTIB", TIB_DEPOSITS, F.col("check_tot_amount")),
        ("DEMDEM", DEM_DEPOSITS, F.col("check_tot_amount")),
    ]

    def valued(rows: DataFrame, choices: list) -> DataFrame:
        return (
            convert_currency(rows, rates, "currency_id", "transfer_debit_date")
            .withColumn("_case", _cheque_case(kind, choices))
            .where(F.col("_case").isNotNull())
            .select(
                "credit_internal_account_id",
                joined_key("_case.prefix", "cie_transaction_type").alias("cheque_key"),
                money(F.col("_case.value") * F.col("exchange_rate")).alias("cheque_amount"),
            )
        )

    family = ConceptFamily(
        name="TIBDEM",
        account="credit_internal_account_id",
        key=F.col("cheque_key"),
        amount=F.col("cheque_amount"),
        round_rows=True,
        subtotals=CHEQUE_SUBTOTALS,
        totals=CHEQUE_TOTALS,
        total_by="code",
        account_key=F.trim("account_id"),
    )
    return valued(cheques, of_cheques).unionByName(valued(deposits, of_deposits)), family


def die(movements: DataFrame) -> Source:
    """Dispersal fees by kind and channel; a missing or blank channel is ``OT``."""
    channel = F.when(
        F.col("channel_id").isNotNull() & (F.trim("channel_id") != ""),
        F.substring("channel_id", 1, 2),
    ).otherwise(F.lit("OT"))
    family = ConceptFamily(
        name="DIE",
        account="agreement_dispersal_acct_id",
        key=joined_key(F.lit("DIE"), F.substring("movement_desc", 1, 2), channel),
        amount=F.col("fee_amount"),
        subtotals=DIE_SUBTOTALS,
        totals=DIE_TOTALS,
    )
    return movements, family


def dom(movements: DataFrame, issuances: DataFrame) -> Source:
    """Direct debits, negative; operations are the receipts issued.

    A debit takes account and channel from the newest version of its issuance.
    """
    channel = F.col("source_channel_id")
    way = F.when(channel.isin(*MANUAL_CHANNELS), F.lit("MAN")).otherwise(F.lit("DIG"))
    family = ConceptFamily(
        name="DOM",
        account="source_account_id",
        key=joined_key(F.lit("DOM"), way, channel),
        amount=-F.col("debited"),
        operations=F.col("receipts"),
        subtotals=DOM_SUBTOTALS,
        totals=DOM_TOTALS,
    )
    return debits_by_issuance(movements, issuances), family


def join_issuances(movements: DataFrame, issuances: DataFrame) -> DataFrame:
    """Debit movements, row by row, with account and channel of their newest issuance."""
    newest = newest_versions(issuances, ["issuing_id"], "load_date").drop("load_date")
    return movements.join(newest, "issuing_id", "inner")


def debits_by_issuance(movements: DataFrame, issuances: DataFrame) -> DataFrame:
    """The sums of :func:`join_issuances` per issuance, account and channel.

    Debits are summed per issuance and tied issuances are counted before the two
    meet, so an issuance with very many debits is one row in the join.
    """
    sums = movements.groupBy("issuing_id").agg(
        F.sum("debit_amount").alias("debited"),
        F.sum("issued_receipt_number").alias("receipts"),
    )
    copies = newest_copies(
        issuances, "issuing_id", "load_date", carry=("source_account_id", "source_channel_id")
    )
    return sums.join(copies, "issuing_id", "inner").select(
        "source_account_id",
        "source_channel_id",
        (
            F.col("debited").cast("decimal(23,8)") * F.col("copies").cast("decimal(14,0)")
        ).alias("debited"),
        (F.col("receipts") * F.col("copies")).alias("receipts"),
    )


def h2h(movements: DataFrame, rates: DataFrame) -> Source:
    """Host-to-host by the service's last four characters; the sum is rounded."""
    family = ConceptFamily(
        name="H2H",
        account="primary_subject_id",
        key=joined_key(F.lit("H2H"), F.substring("subservice_type", -4, 4)),
        amount=F.col("exchange_rate") * F.col("transaction_amount"),
        subtotals=H2H_SUBTOTALS,
        totals=H2H_TOTALS,
    )
    valued = convert_currency(
        movements, rates, "operation_currency_type", "transaction_date"
    )
    return valued, family


def nom(movements: DataFrame) -> Source:
    """Payrolls by channel: none is ``OT``, the central bank ``BX``, else two characters."""
    channel = F.col("payroll_channel_id")
    short = (
        F.when(channel.isNull(), F.lit("OT"))
        .when(channel == CENTRAL_BANK, F.lit("BX"))
        .otherwise(F.substring(channel, 1, 2))
    )
    family = ConceptFamily(
        name="NOM",
        account="commerce_account_id",
        key=joined_key(F.lit("NOMNO"), short),
        amount=F.col("payroll_amount"),
        subtotals=NOM_SUBTOTALS,
        totals=NOM_TOTALS,
    )
    return movements, family
