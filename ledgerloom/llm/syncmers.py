"""Document fingerprints from closed syncmers, DataFrame functions only.

Letters here are words.  A run of ``K`` words is an anchor if the smallest hash among its
inner runs of ``S`` words belongs to the first or the last of them.  Whether a run is an
anchor depends on the run alone, so an edit moves no anchor outside its own reach, and
anchors keep the order of the text.  A fingerprint is the anchors' 32-bit hashes in text
order, eight hex digits each; likeness is the Jaccard similarity of two anchor sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.text import let, words

K = 8
S = 2


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Hashes of the anchors in order; a text of fewer than ``k`` words is one anchor, one without words has none.

    A longer text without an anchor has the smallest hash of its runs, so that only texts without words have none.
    """
    if not 2 <= s < k:
        raise ValueError("2 <= s < k is needed")
    span = k - s + 1

    def chosen(inner: Column) -> Column:
        def pick(first: Column, i: Column) -> Column:
            run = F.slice(inner, i + 1, span)
            whole = i <= F.size(inner) - span
            return F.when(whole & (F.array_min(run) == F.least(first, F.get(inner, i + (span - 1)))), F.hash(run))

        def or_smallest(found: Column) -> Column:
            runs = F.transform(F.sequence(F.lit(0), F.size(inner) - span), lambda i: F.hash(F.slice(inner, i + 1, span)))
            return F.when(F.size(found) == 0, F.array(F.array_min(runs))).otherwise(found)

        return let(F.filter(F.transform(inner, pick), lambda x: x.isNotNull()), or_smallest)

    def of_words(word: Column) -> Column:
        hashed = F.transform(word, lambda x, i: F.xxhash64(x, *[F.get(word, i + j) for j in range(1, s)]))
        inner = F.slice(hashed, F.lit(1), F.size(word) - (s - 1))
        short = F.when(F.size(word) == 0, F.array().cast("array<int>")).otherwise(F.array(F.hash(word)))
        return F.when(F.size(word) < k, short).otherwise(let(inner, chosen))

    return let(words(text), of_words)


def fingerprint(anchor: Column) -> Column:
    """Anchor hashes as text, in order."""
    digits = F.transform(anchor, lambda x: F.lpad(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors over all anchors, 0 to 1; two texts without words are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def _below(splits: list, key: Column) -> Column:
    """How many of the ascending ``splits`` are smaller than ``key``, by halving."""
    held = F.array(*[F.lit(x) for x in splits]).cast("array<bigint>")

    def halve(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        right = (a["lo"] < a["hi"]) & (F.get(held, mid) < key)
        return F.struct(F.when(right, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(right | (a["lo"] >= a["hi"]), a["hi"]).otherwise(mid).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(splits)).alias("hi"))
    steps = F.sequence(F.lit(1), F.lit(len(splits).bit_length() + 1))
    return F.aggregate(steps, start, halve, lambda a: a["lo"])


def with_next(rows: DataFrame, key: str, columns: list[str], groups: int | None = None) -> DataFrame:
    """``next_<column>``: values of the row with the next smaller ``key``; the last row is followed by the first.

    Rows are cut into ranges of about equal size by approximate quantiles of the key.  The
    first row of a range also visits the range before it, so one exchange does, and no
    range holds all rows.  The driver gets one number for each range.  Null keys come last;
    rows of one key follow each other by a hash of ``columns``.
    """
    spark = rows.sparkSession
    groups = groups or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / groups for i in range(1, groups)]
    found = rows.agg(F.percentile_approx(key, shares, 20 * groups)).first()[0] or []
    splits = sorted(set(found))
    group = F.when(F.col(key).isNull(), F.lit(-1)).otherwise(_below(splits, F.col(key)) if splits else F.lit(0)).cast("int")
    rows = rows.withColumn("_group", group)
    heads = sorted(((r[0], r[1]) for r in rows.groupBy("_group").agg(F.max(key)).collect()), reverse=True)
    before = [heads[i - 1][0] for i in range(len(heads))]
    guide = spark.createDataFrame([(g, k, b) for (g, k), b in zip(heads, before, strict=True)], "_group int, _first bigint, _before int")
    visits = F.when(F.col(key).eqNullSafe(F.col("_first")), F.array(F.struct(F.col("_group").alias("at"), F.lit(0).alias("lap")), F.struct(F.col("_before").alias("at"), F.lit(1).alias("lap"))))
    own = F.array(F.struct(F.col("_group").alias("at"), F.lit(0).alias("lap")))
    seated = rows.join(F.broadcast(guide), "_group").withColumn("_seat", F.explode(F.coalesce(visits, own)))
    order = W.partitionBy("_seat.at").orderBy("_seat.lap", F.col(key).desc_nulls_last(), F.xxhash64(*columns))
    named = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return seated.withColumns(named).where("_seat.lap = 0").drop("_group", "_first", "_before", "_seat")


def edited_fingerprints(docs: DataFrame, k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited form.

    The edited text has its last ``floor(n / 2)`` code points replaced by as many of the
    next document's first.  Null texts count as empty; a single document is its own next;
    an empty table gives an empty result; other columns of ``docs`` are not read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("anchors", anchors(F.col("text"), k, s))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    rows = with_next(rows, "doc_id", ["text", "anchors"]).withColumn("edited", edited)
    rows = rows.withColumn("edited_anchors", anchors(F.col("edited"), k, s))
    return rows.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("anchors")).alias("fingerprint"),
        fingerprint(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
