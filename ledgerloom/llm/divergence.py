"""How far apart the sources of a language are in their use of terms.

Terms are counted per language and source, and a language keeps those that enough of its documents hold.  Each kept term
gets an id, each source a sorted array of (id, share) pairs per bucket of ids, and each unordered pair of sources a task per
bucket: the shorter array walks, the longer one is searched by galloping, and only terms that both hold are met one by one.
Terms of one side alone and terms of neither cost the same against any source of equal size and are priced in sums.  All
arithmetic is in whole numbers; everything stays in SQL functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import let
from ledgerloom.session import scratch_path

LEAST_DOCUMENTS = 10
TOP_TERMS = 10
SHARE = 1_000_000_000
#: Terms of one source in one task, on average at most; an array may be 2**MOST_DOUBLINGS long.
BUCKET_TERMS = 1 << 13
MOST_DOUBLINGS = 20
#: Array terms that a pair task walks, roughly, before another task is worth it.
TASK_TERMS = 1 << 18
SEPARATORS = "".join(chr(c) for c in range(128) if chr(c) not in string.ascii_letters)


def terms(text: Column) -> Column:
    """The terms of a text in order, with empty ones between; only A to Z are lower-cased."""
    plain = F.translate(text, string.ascii_uppercase + SEPARATORS, string.ascii_lowercase + " " * len(SEPARATORS))
    return F.split(plain, " ")


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def price(p: Column, q: Column) -> Column:
    """``floor((p - q)**2 / (p + q))``."""
    return _whole((p - q) * (p - q), p + q)


def share(count: Column, total: Column, kept: Column) -> Column:
    """``1 + floor(SHARE * (count + 2) / (total + 2 * kept))``, 1 where nothing is kept."""
    exact = (count + 2).cast("decimal(20,0)") * F.lit(SHARE).cast("decimal(10,0)")
    return F.when(kept > 0, 1 + _whole(exact, (total + 2 * kept).cast("decimal(20,0)"))).otherwise(F.lit(1)).cast("bigint")


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences, and documents that hold the term."""
    text, lang, source = (F.coalesce(c, F.lit("")) for c in ("text", "lang", "source"))
    cut = docs.select(lang.alias("lang"), source.alias("source"), terms(text).alias("terms"))
    # Every occurrence, then every distinct term once more.
    both = cut.select("lang", "source", F.size("terms").alias("size"), F.posexplode(F.concat("terms", F.array_distinct("terms"))).alias("at", "term"))
    occurs = F.col("at") < F.col("size")
    return both.where(F.col("term") != "").groupBy("lang", "source", "term").agg(F.count_if(occurs).alias("n"), F.count_if(~occurs).alias("docs"))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, total, sources`` of the terms that at least ``least`` documents of the language hold; one entry per source."""
    grouped = term_counts(docs).groupBy("lang", "term")
    gathered = grouped.agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    return gathered.where(F.col("docs") >= least).drop("docs")


def first_at_least(ids: Column, start: Column, wanted: Column) -> Column:
    """The first place from ``start`` on whose id is not below ``wanted``, found by doubling steps and then halving ones."""
    below = lambda at: F.coalesce(F.get(ids, at) < wanted, F.lit(False))
    steps = F.when(~below(start + 2), F.lit(1))
    for k in range(2, MOST_DOUBLINGS + 1):
        steps = steps.when(~below(start + (1 << k)), F.lit(k))

    def halved(k: Column) -> Column:
        """Between the last step below ``wanted`` and the first one not below it."""
        low = start + F.call_function("shiftleft", F.lit(1), k - 1)
        sizes = F.when(k > 1, F.sequence(k - 2, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
        closer = lambda at, s: let(at + F.call_function("shiftleft", F.lit(1), s), lambda x: F.when(below(x), x).otherwise(at))
        return F.aggregate(sizes, low, closer) + 1

    # Places next to each other are the common case and need no search.
    return F.when(~below(start), start).when(~below(start + 1), start + 1).otherwise(let(steps, halved))


def shared_price(ids: Column, shares: Column, absent: Column, other_ids: Column, other_shares: Column, other_absent: Column) -> Column:
    """What the terms of both arrays cost beyond the prices of being on one side alone.

    ``ids`` are walked one by one and searched for among ``other_ids``; both ascend.  A step prices the place that the step before
    it found.
    """

    def gain(state: Column) -> Column:
        p, q = F.get(shares, state["next"] - 1), F.get(other_shares, state["at"])
        more = price(p, q) - price(p, other_absent) - price(absent, q) + price(absent, other_absent)
        return F.when(F.get(other_ids, state["at"]) == state["id"], state["gain"] + more).otherwise(state["gain"])

    def step(state: Column, wanted: Column) -> Column:
        at = first_at_least(other_ids, state["at"], wanted)
        return F.struct(at.alias("at"), (state["next"] + 1).alias("next"), wanted.alias("id"), gain(state).alias("gain"))

    # Before the first step no id is looked for; a null one equals none.
    none = F.lit(None).cast("bigint")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("next"), none.alias("id"), F.lit(0).cast("bigint").alias("gain"))
    return F.aggregate(ids, start, step, gain)


def one_sided_price(levels: Column, absent: Column) -> Column:
    """What all terms of a source cost against their absence; ``levels`` has each share once, with its number of terms."""
    return F.aggregate(levels, F.lit(0).cast("bigint"), lambda total, x: total + x["n"] * price(x["p"], absent))


def _pair_price() -> Column:
    """Price of all terms of a bucket between the sources of columns ``a_`` and ``b_``."""
    side = lambda x: tuple(F.col(f"{x}_{c}") for c in ("ids", "shares", "absent"))
    (a_ids, _, a_absent), (b_ids, _, b_absent) = side("a"), side("b")
    both = F.when(F.size(a_ids) <= F.size(b_ids), shared_price(*side("a"), *side("b"))).otherwise(shared_price(*side("b"), *side("a")))
    rest = (F.col("terms") - F.size(a_ids) - F.size(b_ids)) * price(a_absent, b_absent)
    return both + rest + one_sided_price(F.col("a_levels"), b_absent) + one_sided_price(F.col("b_levels"), a_absent)


def _ranked(rows: DataFrame, part: str, top: int | None = None) -> DataFrame:
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = rows.withColumn("rank", F.row_number().over(best))
    if top:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, bucket_terms: int = BUCKET_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` over all ``docs`` (text, lang, source).

    Part ``pair`` has the price of every other source of the language, part ``term`` the ``top`` terms that the source uses
    more than its language does.  Null text, language and source count as empty; a document without terms still makes its
    source a group, which has pairs at a price of 0 where the language keeps no term.  Repeated rows are documents of their
    own.  Ties rank by the bytes of the item.  A language with one source has no pairs; an empty table gives no rows; other
    columns are not read.
    """
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "terms")
    # Stored, so that the ids of terms stay what they are if a task is lost.
    kept_terms(docs, least).withColumn("id", F.monotonically_increasing_id()).write.parquet(path)
    kept = spark.read.parquet(path)

    languages = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    buckets = max(1, -(-(languages.agg(F.max("kept")).first()[0] or 0) // bucket_terms))
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int").alias("bucket")
    entries = kept.select("lang", bucket, "id", "term", "total", F.inline("sources"))

    groups = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(languages, "lang", "left").na.fill(0, ["source_total", "kept", "lang_total"])
    in_bucket = kept.groupBy("lang", bucket).agg(F.count("*").alias("terms"))
    cells = sized.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))).join(in_bucket, ["lang", "bucket"], "left").na.fill(0, ["terms"])

    size = (F.col("source_total"), F.col("kept"))
    p, q = share(F.col("n"), *size), share(F.col("total"), F.col("lang_total"), F.col("kept"))
    held = cells.join(entries, ["lang", "source", "bucket"], "left").withColumns({"p": p, "q": q})

    over = held.where(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), price(F.col("p"), F.col("q")).alias("value"))
    term_rows = _ranked(over, "term", top)

    absent = share(F.lit(0), *size)
    cell = ["lang", "source", "bucket", "terms", "absent"]
    by_share = held.withColumn("absent", absent).groupBy(*cell, "p").agg(F.collect_list("id").alias("same"), F.count("id").alias("n"))
    with_share = F.transform("same", lambda i: F.struct(i.alias("id"), F.col("p").alias("p")))
    sorted_terms = by_share.groupBy(*cell).agg(
        F.array_sort(F.flatten(F.collect_list(with_share))).alias("pairs"), F.collect_list(F.when(F.col("n") > 0, F.struct("p", "n"))).alias("levels")
    )

    def side(name: str) -> list[Column]:
        columns = {"ids": F.col("pairs.id"), "shares": F.col("pairs.p"), "levels": F.col("levels"), "absent": F.col("absent")}
        return [c.alias(f"{name}_{n}") for n, c in columns.items()]

    # Of an unordered pair, which source walks first in the key is drawn by a hash, so that no source is in all keys.
    other = groups.select(F.col("lang").alias("_lang"), F.col("source").alias("other"))
    even = F.pmod(F.xxhash64(F.least("source", "other"), F.greatest("source", "other")), F.lit(2)) == 0
    once = F.when(even, F.col("source") < F.col("other")).otherwise(F.col("source") > F.col("other"))
    per_language = groups.groupBy("lang").agg((F.count("*") * (F.count("*") - 1) / 2).cast("bigint").alias("pairs"))
    work = per_language.join(languages, "lang").agg(F.sum(F.col("pairs") * F.col("kept"))).first()[0] or 0
    tasks = max(1, -(-work // TASK_TERMS))
    arrays = sorted_terms.select("lang", "source", "bucket", "terms", *side("a"))
    first = arrays.join(other, (F.col("lang") == F.col("_lang")) & once).drop("_lang")
    dealt = first.repartition(tasks, "lang", "other", "bucket")
    second = sorted_terms.select("lang", F.col("source").alias("other"), "bucket", *side("b"))
    priced = dealt.join(second, ["lang", "other", "bucket"]).select("lang", "source", "other", _pair_price().alias("value"))
    summed = priced.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    both_ways = F.inline(F.array(F.struct("source", F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("source").alias("item"))))
    pair_rows = _ranked(summed.select("lang", "value", both_ways), "pair")
    return pair_rows.unionByName(term_rows)
