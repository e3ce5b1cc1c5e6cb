"""The customer universe: known customers plus those who share a tax id with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.snapshots import rows_at_newest

# Role of the account holder in a contract.
HOLDER_TYPE = "T"
HOLDER_ID = "01"


def holder_contracts(contracts: DataFrame, odate: str) -> DataFrame:
    """Contracts of the newest load in which the customer is the holder."""
    holder = (F.col("account_intervention_type") == HOLDER_TYPE) & (
        F.col("account_interventon_id") == HOLDER_ID
    )
    return (
        rows_at_newest(contracts, "load_date", odate)
        .where(holder)
        .select(
            "customer_id",
            F.concat(F.trim("product_type"), F.trim("account_id")).alias("account"),
            "account_register_branch_id",
        )
    )


def customer_tax_ids(customers: DataFrame, odate: str) -> DataFrame:
    """Distinct customers of the newest load with their full tax id."""
    return (
        rows_at_newest(customers, "load_date", odate)
        .select(
            "customer_id",
            F.concat(F.trim("rfc_id"), F.trim("homoclave_name")).alias("rfc_id_basic"),
        )
        .distinct()
    )


def known_customers(catalogue: DataFrame, tax_ids: DataFrame, odate: str) -> DataFrame:
    """Catalogue customers of the newest cutoff; the tax id is null when unknown."""
    known = rows_at_newest(catalogue, "cutoff_date", odate).select("customer_id").distinct()
    return known.join(tax_ids, "customer_id", "left")


def sharing_tax_id(known: DataFrame, tax_ids: DataFrame) -> DataFrame:
    """All customers that share a tax id with a known one, themselves included.

    Only membership counts, so the known tax ids are made distinct first and the
    pairs within one tax id are never built.
    """
    ids = known.select("rfc_id_basic").distinct()
    return tax_ids.join(ids, "rfc_id_basic", "left_semi").select("customer_id", "rfc_id_basic")


def customer_universe(
    customers: DataFrame, catalogue: DataFrame, contracts: DataFrame, odate: str
) -> DataFrame:
    """Contracts of the known customers and of those sharing a tax id with them."""
    tax_ids = customer_tax_ids(customers, odate)
    known = known_customers(catalogue, tax_ids, odate)
    added = sharing_tax_id(known, tax_ids).join(known, ["customer_id", "rfc_id_basic"], "left_anti")
    return (
        known.unionByName(added)
        .join(holder_contracts(contracts, odate), "customer_id", "inner")
        .select("customer_id", "rfc_id_basic", "account", "account_register_branch_id")
    )
