"""The financial-profit pipeline: stored tables in, one fact table out."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from ledgerloom.operators.concepts import (
    all_commission_concepts,
    concept_rollup,
    signed_movements,
)
from ledgerloom.operators.snapshots import current_catalogue
from ledgerloom.plans import families
from ledgerloom.schemas import as_fact
from ledgerloom.sources import movements as read


def union_facts(*parts: DataFrame) -> DataFrame:
    """Fact frames stacked by column name after conforming each to the layout."""
    return reduce(DataFrame.unionByName, [as_fact(p) for p in parts])


def base_concepts(tables: Mapping[str, DataFrame], odate: str) -> DataFrame:
    """First part: earlier facts, general movements and both commission sources.

    Tables: ``earlier_facts, accounts, catalogue, general_movements, commissions,
    branch_commissions``.
    """
    accounts, catalogue = tables["accounts"], current_catalogue(tables["catalogue"])
    return union_facts(
        tables["earlier_facts"],
        signed_movements(read.general_movements(tables["general_movements"], odate), accounts, catalogue, odate),
        all_commission_concepts(
            read.commissions(tables["commissions"], odate),
            read.branch_commissions(tables["branch_commissions"], odate),
            accounts,
            catalogue,
            odate,
        ),
    )


def family_sources(tables: Mapping[str, DataFrame], odate: str, datem: str) -> list[families.Source]:
    """Valued movements of the seven rolled-up families."""
    rates = read.daily_rates(tables["rates"], odate)
    return [
        families.sit(read.transfers(tables["transfers"], odate, datem), rates),
        families.cie(read.collections_by_agreement(tables["collections"], odate, datem), rates),
        families.tib_dem(
            read.cheques(tables["cheques"], odate, datem),
            read.cheque_deposits(tables["deposits"], odate, datem),
            rates,
        ),
        families.dom(
            read.debit_movements(tables["debits"], odate),
            read.debit_issuances(tables["issuances"], odate),
        ),
        families.die(read.dispersals(tables["dispersals"], odate)),
        families.h2h(read.host_to_host(tables["host_to_host"], odate), rates),
        families.nom(read.payrolls(tables["payrolls"], odate)),
    ]


def rolled_concepts(tables: Mapping[str, DataFrame], odate: str, datem: str) -> DataFrame:
    """The seven rolled-up families in one plan: one account join, one roll-up."""
    return concept_rollup(
        family_sources(tables, odate, datem),
        tables["accounts"],
        current_catalogue(tables["catalogue"]),
        odate,
    )


def profit_facts(
    tables: Mapping[str, DataFrame], odate: str, datem: str, base: DataFrame | None = None
) -> DataFrame:
    """Both parts.  Pass the stored first part as ``base`` when it was written before."""
    first = base if base is not None else base_concepts(tables, odate)
    return union_facts(first, rolled_concepts(tables, odate, datem))
