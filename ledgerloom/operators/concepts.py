"""Roll-up of movements into detail, subtotal and total concept rows.

The rows of all three levels follow from the movement's composed key and the
catalogue alone: the detail concept's code picks a subtotal concept, and that
concept's product (or the code again) picks a total concept.  The catalogue is
small, so the whole chain is worked out on it once (:func:`level_map`).  Movements
are summed per account and key, meet the accounts once, and are summed once more
over all levels together.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.functions.keys import flipped_if, money, padded_account, two_digit
from ledgerloom.operators.snapshots import catalogue_of, coded_concepts, open_account_copies

AMOUNT_SUFFIX = "IMP"
COUNT_SUFFIX = "OPE"
_CATALOGUE = (
    "primary_key_type",
    "data_code_id",
    "sender_application_id",
    "commercial_product_type",
    "commercial_subproduct_type",
)


@dataclass(frozen=True)
class ConceptFamily:
    """How one kind of movement turns into concept rows.

    ``round_rows`` rounds each movement to two decimals before summing; otherwise
    the sum is rounded.  ``total_by`` says what picks the total concept: the
    subtotal's ``product`` or the detail ``code``.
    """

    name: str
    account: str
    key: Column
    amount: Column
    subtotals: dict[str, str]
    totals: dict[str, str]
    operations: Column | None = None
    round_rows: bool = False
    total_by: str = "product"
    account_key: Column = field(default_factory=lambda: F.col("account_id"))


def _valued(movements: DataFrame, family: ConceptFamily) -> DataFrame:
    amount = money(family.amount) if family.round_rows else family.amount
    operations = family.operations if family.operations is not None else F.lit(1)
    return (
        movements.select(
            F.col(family.account).alias("account_id"),
            family.key.alias("concept_key"),
            amount.alias("amount"),
            operations.cast("bigint").alias("operations"),
        )
        .where(F.col("concept_key").isNotNull())
        .withColumns({"family": F.lit(family.name), "account_key": family.account_key})
    )


def _kept_scale(df: DataFrame, column: str) -> Column:
    """A decimal with all its places, narrow enough to be multiplied by a count without losing any."""
    return F.col(column).cast(f"decimal(23,{max(8, df.schema[column].dataType.scale)})")


def detail_sums(sources: list[tuple[DataFrame, ConceptFamily]], catalogue: DataFrame | None = None) -> DataFrame:
    """Movements of all families summed per account and key, before they meet the accounts.

    Columns ``family, account_id, account_key, concept_key, amount, operations``.
    The first aggregation step runs on the map side, so an account or a key with a third of all movements sends one row
    per task to the shuffle.  With a ``catalogue``, keys without a concept leave after that: there are few keys, and
    however large the catalogue is, only sums are ever dealt out by key.
    """
    rows = reduce(DataFrame.unionByName, [_valued(m, f) for m, f in sources])
    summed = rows.groupBy("family", "account_id", "account_key", "concept_key").agg(
        F.sum("amount").alias("amount"), F.sum("operations").alias("operations")
    )
    summed = summed.withColumn("amount", _kept_scale(summed, "amount"))
    return summed if catalogue is None else known_concepts(summed, catalogue)


def known_concepts(sums: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Detail sums whose key has a concept in the catalogue."""
    suffixes = f"({AMOUNT_SUFFIX}|{COUNT_SUFFIX})$"
    known = catalogue.select(F.regexp_replace("primary_key_type", suffixes, "").alias("concept_key")).distinct()
    return sums.join(known, "concept_key", "left_semi")


def keep_open_accounts(sums: DataFrame, copies: DataFrame) -> DataFrame:
    """Detail sums of open accounts, multiplied by the number of tied versions."""
    versions = copies.select(F.col("account_id").alias("_account"), "copies")
    times = F.col("copies").cast("decimal(14,0)")
    return sums.join(versions, F.col("account_key") == F.col("_account"), "inner").select(
        "family",
        "account_id",
        "account_key",
        "concept_key",
        (F.col("amount") * times).alias("amount"),
        (F.col("operations") * F.col("copies")).alias("operations"),
    )


def amount_and_count_rows(sums: DataFrame) -> DataFrame:
    """One amount row and one operations row per account and key, in one pass."""
    pair = F.array(
        F.struct(
            F.concat("concept_key", F.lit(AMOUNT_SUFFIX)).alias("primary_key_type"),
            money("amount").alias("analytic_concept_amount"),
        ),
        F.struct(
            F.concat("concept_key", F.lit(COUNT_SUFFIX)).alias("primary_key_type"),
            money("operations").alias("analytic_concept_amount"),
        ),
    )
    return sums.select("family", "account_id", "account_key", F.inline(pair))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _level(family: str, level: str, group: str, target: str) -> str:
    """One level entry as SQL; ``group`` and ``target`` are SQL themselves."""
    return (
        f"named_struct('family', {_text(family)}, 'level', '{level}', "
        f"'group_id', {group}, 'target_key', {target})"
    )


def _levels_of_code(families: list[ConceptFamily]) -> str:
    """For a detail code, the subtotal and code-based total concepts it adds to (SQL)."""
    found: dict[str, list[str]] = {}
    for f in families:
        for code, key in f.subtotals.items():
            entry = _level(f.name, "subtotal", _text(code), _text(key))
            found.setdefault(code, []).append(entry)
        if f.total_by == "code":
            for code, key in f.totals.items():
                entry = _level(f.name, "total", _text(key), _text(key))
                found.setdefault(code, []).append(entry)
    pairs = ", ".join(f"{_text(c)}, array({', '.join(entries)})" for c, entries in found.items())
    return f"try_element_at(map({pairs}), data_code_id)"


def _total_of_product(families: list[ConceptFamily]) -> str:
    """Total concept key for ``family`` and ``product``; null when it has none (SQL)."""
    pairs = ", ".join(
        f"{_text(f.name + '|' + product)}, {_text(key)}"
        for f in families
        if f.total_by == "product"
        for product, key in f.totals.items()
    )
    if not pairs:
        return "CAST(NULL AS STRING)"
    return f"try_element_at(map({pairs}), concat_ws('|', family, product))"


def level_map(catalogue: DataFrame, families: list[ConceptFamily]) -> DataFrame:
    """For each family and detail key, the concept rows it adds to.

    Columns ``family, primary_key_type, level, group_id, target_key, weight``.
    ``group_id`` is what the level is grouped by, ``target_key`` the concept it
    becomes and ``weight`` how often the key counts (more than once only where the
    catalogue repeats a key).  Only the catalogue is read, and per key there are no
    more rows than families, codes and products.
    """
    concepts = catalogue.select(
        "primary_key_type", "data_code_id", "commercial_product_type"
    ).where(F.col("primary_key_type").isNotNull())
    # The detail concept stands for itself whatever the family.
    itself = "array({})".format(
        ", ".join(_level(f.name, "detail", "primary_key_type", "primary_key_type") for f in families)
    )
    upper = _levels_of_code(families)
    direct = concepts.selectExpr(
        "primary_key_type",
        f"inline(CASE WHEN {upper} IS NULL THEN {itself} ELSE concat({itself}, {upper}) END)",
    )
    # A subtotal leads on to the total of its own concept's product.
    products = concepts.select(
        F.col("primary_key_type").alias("sub_key"),
        F.col("commercial_product_type").alias("product"),
    ).where(F.col("product").isNotNull())
    totals = (
        direct.where(F.col("level") == "subtotal")
        .join(products, F.col("target_key") == F.col("sub_key"))
        .select(
            "primary_key_type",
            "family",
            F.lit("total").alias("level"),
            F.col("product").alias("group_id"),
            F.expr(_total_of_product(families)).alias("target_key"),
        )
        .where(F.col("target_key").isNotNull())
    )
    return (
        direct.unionByName(totals)
        .groupBy("family", "primary_key_type", "level", "group_id", "target_key")
        .agg(F.count("*").alias("found"))
        .withColumn("weight", F.when(F.col("level") == "detail", F.lit(1)).otherwise(F.col("found")))
        .drop("found")
    )


def concept_rows(catalogue: DataFrame) -> DataFrame:
    """The output columns of each concept, with its number of catalogue rows."""
    concepts = catalogue.select(*_CATALOGUE).where(F.col("primary_key_type").isNotNull())
    repeats = concepts.groupBy("primary_key_type").agg(F.count("*").alias("repeats"))
    return concepts.join(repeats, "primary_key_type").withColumnRenamed("primary_key_type", "target_key")


def roll_up(
    detail: DataFrame,
    catalogue: DataFrame,
    families: list[ConceptFamily],
    odate: str,
) -> DataFrame:
    """Detail rows (:func:`amount_and_count_rows`) to fact rows of all three levels.

    The only grouping is by account, level and concept.
    """
    by_code = [f.name for f in families if f.total_by == "code"]
    levels = level_map(catalogue, families)
    summed = (
        detail.join(levels, ["family", "primary_key_type"])
        .groupBy("account_key", "account_id", "family", "level", "group_id", "target_key")
        .agg(
            F.sum(F.col("analytic_concept_amount") * F.col("weight").cast("decimal(10,0)")).alias(
                "analytic_concept_amount"
            )
        )
    )
    out = summed.join(concept_rows(catalogue), "target_key")
    # A concept listed twice repeats the row once per listing and lookup.
    single = (F.col("level") != "detail") & F.col("family").isin(*by_code) if by_code else F.lit(False)
    times = F.when(single, F.lit(1)).otherwise(F.col("repeats").cast("int"))
    repeated = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
    return repeated.select(
        "account_id",
        F.col("data_code_id").alias("analytic_concept_id"),
        "sender_application_id",
        "commercial_product_type",
        "commercial_subproduct_type",
        money("analytic_concept_amount").alias("analytic_concept_amount"),
        as_date(odate).alias("cutoff_date"),
    )


def concept_rollup(
    sources: list[tuple[DataFrame, ConceptFamily]],
    accounts: DataFrame,
    catalogue: DataFrame,
    odate: str,
    dedupe_accounts: bool = False,
) -> DataFrame:
    """Fact rows of one or many families; accounts and catalogue are joined once."""
    copies = open_account_copies(accounts, odate, dedupe=dedupe_accounts)
    families = list({f.name: f for _, f in sources}.values())
    detail = amount_and_count_rows(keep_open_accounts(detail_sums(sources, catalogue), copies))
    return roll_up(detail, catalogue, families, odate)


def _fact(grouped: DataFrame, account: str, odate: str) -> DataFrame:
    return grouped.select(
        F.col(account).alias("account_id"),
        F.col("data_code_id").alias("analytic_concept_id"),
        "sender_application_id",
        "product_cat",
        "subproduct_cat",
        money("amount").alias("analytic_concept_amount"),
        as_date(odate).alias("cutoff_date"),
    ).withColumnsRenamed(
        {
            "product_cat": "commercial_product_type",
            "subproduct_cat": "commercial_subproduct_type",
        }
    )


_PRODUCTS = ("commercial_product_type", "commercial_subproduct_type")


def _codes(catalogue: DataFrame, key: str, *more: str) -> DataFrame:
    """Concepts by key, equal rows once with their number as ``weight``."""
    return (
        catalogue.where(F.col("primary_key_type").isNotNull())
        .groupBy(
            F.col("primary_key_type").alias(key),
            "data_code_id",
            "sender_application_id",
            *more,
            F.col("commercial_product_type").alias("product_cat"),
            F.col("commercial_subproduct_type").alias("subproduct_cat"),
        )
        .agg(F.count("*").alias("weight"))
    )


def _times(*counts: str) -> Column:
    return reduce(lambda a, b: a * b, [F.col(c) for c in counts]).cast("decimal(14,0)")


def signed_movements(movements: DataFrame, accounts: DataFrame, catalogue: DataFrame, odate: str) -> DataFrame:
    """General movements (B40W) with the catalogue's sign, at their own fine grain.

    A plus sign in the catalogue turns the amount negative.  Amounts stay in their
    own currency.  Product and subproduct of the account are part of the grain.

    Movements are summed at their own grain first, and only sums meet the catalogue: equal codes of a key are one row with a weight, so
    the join keeps the grain.  Nothing is grouped after the account join: a partition that a busy account makes too large is
    split there.
    """
    codes = _codes(coded_concepts(catalogue), "movement_key", "sign_type")
    grain = ("load_date", "transaction_date", "transaction_desc", "currency_id", "movement_key")
    sums = (
        movements.withColumn("account", F.concat("counterpart_id", "folio_contract_id"))
        .where(F.col("account").isNotNull() & F.col("movement_key").isNotNull())
        .groupBy("account", *grain)
        .agg(F.sum("transaction_amount").alias("amount"))
        .join(codes, "movement_key")
    )
    signed = flipped_if(F.col("sign_type") == "+", "amount")
    sums = sums.withColumn("amount", signed)
    copies = open_account_copies(accounts, odate, _PRODUCTS).select("account_id", "copies")
    # The second key says nothing new.  It makes both sides be dealt out afresh: only such exchanges can be split,
    # while the summary's own partitioning by account would be reused as it is.
    same = (F.col("account") == F.col("account_id")) & (F.length("account") == F.length("account_id"))
    held = sums.join(copies, same, "inner")
    return _fact(held.withColumn("amount", _kept_scale(sums, "amount") * _times("weight", "copies")), "account_id", odate)


def _commission_sums(movements: DataFrame, account_key: Column, catalogue: DataFrame) -> DataFrame:
    keys = catalogue_of(catalogue, "SIC").select(F.col("primary_key_type").alias("concept_key")).distinct()
    return (
        movements.where(F.col("concept_key").isNotNull())
        .groupBy("commission_account_id", "concept_key")
        .agg(F.sum("total_commission_tax_amount").alias("amount"))
        .join(keys, "concept_key", "left_semi")
        .withColumn("account_key", account_key)
    )


def _plain_commissions(movements: DataFrame, catalogue: DataFrame) -> DataFrame:
    return _commission_sums(movements, F.col("commission_account_id"), catalogue)


def _branch_commissions(movements: DataFrame, catalogue: DataFrame) -> DataFrame:
    keyed = movements.withColumn("concept_key", F.concat(F.lit("SICCOBR5"), two_digit("card_service_type")))
    return _commission_sums(keyed, padded_account("commission_account_id"), catalogue)


def _commission_facts(sums: DataFrame, accounts: DataFrame, catalogue: DataFrame, odate: str) -> DataFrame:
    """Commission sums as facts: one account join, rows of one account and concept summed."""
    versions = open_account_copies(accounts, odate, _PRODUCTS)
    copies = versions.groupBy("account_id").agg(F.sum("copies").alias("copies"))
    held = sums.join(copies, F.col("account_key") == F.col("account_id"), "inner")
    coded = held.join(_codes(catalogue_of(catalogue, "SIC"), "concept_key"), "concept_key")
    grouped = coded.groupBy(
        "account_key",
        "commission_account_id",
        "data_code_id",
        "sender_application_id",
        "product_cat",
        "subproduct_cat",
        F.expr("substring(concept_key, 1, 8)").alias("source"),
    ).agg(F.sum(_kept_scale(sums, "amount") * _times("weight", "copies")).alias("amount"))
    return _fact(grouped, "commission_account_id", odate)


def commission_concepts(movements: DataFrame, accounts: DataFrame, catalogue: DataFrame, odate: str) -> DataFrame:
    """Commissions (SICOCO) per account and concept."""
    return _commission_facts(_plain_commissions(movements, catalogue), accounts, catalogue, odate)


def branch_commission_concepts(
    movements: DataFrame, accounts: DataFrame, catalogue: DataFrame, odate: str
) -> DataFrame:
    """Commissions (SICOCO5): the padded number finds the account, the plain one is kept."""
    return _commission_facts(_branch_commissions(movements, catalogue), accounts, catalogue, odate)


def all_commission_concepts(
    commissions: DataFrame, branch_commissions: DataFrame, accounts: DataFrame, catalogue: DataFrame, odate: str
) -> DataFrame:
    """Both commission sources with one account join; each keeps rows of its own."""
    sums = _plain_commissions(commissions, catalogue).unionByName(_branch_commissions(branch_commissions, catalogue))
    return _commission_facts(sums, accounts, catalogue, odate)
