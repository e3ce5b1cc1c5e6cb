"""Mixing sources to target weights by systematic sampling, DataFrame functions only.

Every document of a source expects ``target / source size`` copies.  The expected copies
are summed along the source, one random offset per source is added, and a document is
taken once for every whole number its step crosses.  Documents are put along the source
by size, so that copies spread evenly over short and long ones and the words taken stay
close to the target.

The running sum needs no source in one task: the documents of a source fall into many
ordered groups (size class, then a hash), groups are counted, and a document's place is
the count of the groups before its own plus its row number in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.text import word_count

WEIGHTS = (1.0, 2.0, 3.0)
MOST_COPIES = 3
SPLITS = 256
SEED = 20


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, source_size`` with ``target`` added.

    Sources in code point order, null last, take the weights in turn and share the sum of
    all sizes.  No target exceeds ``most`` times its source's size; the excess goes to the
    others by weight until none is above.  That end is one level: ordered by size over
    weight, the first sources stop at their bound and all later ones get level times weight.
    One row per source meets in one task; documents never do.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    by_room = W.orderBy("_room", F.col("source").isNull(), "source")
    everything = W.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    return (
        sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
        .withColumn("_bound", F.lit(float(most)) * F.col("source_size"))
        .withColumn("_room", F.col("_bound") / F.col("_weight"))
        .withColumn("_before", F.coalesce(F.sum("_bound").over(by_room.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("_open", F.sum("_weight").over(by_room.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", (F.sum("source_size").over(everything) - F.col("_before")) / F.col("_open"))
        .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_room"), F.col("_level"))).over(everything))
        .withColumn("target", F.least("_bound", F.coalesce("_level", F.lit(0.0)) * F.col("_weight")))
        .select("source", "source_size", "target")
    )


def mix(
    docs: DataFrame,
    size: Column | None = None,
    key: str = "doc_id",
    weights=WEIGHTS,
    most: int = MOST_COPIES,
    seed: int = SEED,
    splits: int = SPLITS,
) -> DataFrame:
    """``row`` (all columns of a document), ``size``, ``source_size``, ``target`` and ``copies``, a row per document.

    ``size`` is the number of words of ``text`` unless given.  A null text has size 0 and a
    null source is a source of its own.  Repeated rows are documents of their own; ties
    in size are ordered by ``key``.  An empty table gives an empty result.  The columns of
    ``docs`` sit in one struct, so none can clash with a name used here.  The same rows
    and seed give the same copies.
    """
    size = word_count(F.col("text")) if size is None else size
    klass = F.floor(F.log2(F.col("size") + 1) * 8).cast("int")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        size.cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"),
        F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(splits)).cast("int").alias("_split"),
    ).withColumn("_class", klass)
    group = ["_source", "_class", "_split"]
    counted = rows.groupBy(*group).agg(F.count("*").alias("_rows"), F.sum("size").alias("_size"))
    before = W.partitionBy("_source").orderBy("_class", "_split").rowsBetween(W.unboundedPreceding, -1)
    starts = counted.select(*group, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    sources = counted.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    sources = sources.withColumn("source", F.when(F.col("_source") != "", F.expr("substring(_source, 2)")))
    targets = source_targets(sources.select("source", "source_size"), weights, most).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("_source"), "source_size", "target"
    )
    starts = starts.join(targets, "_source")
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A multiple of 2**-20, so that adding it to a whole number is exact.
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col("_source")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    place = F.col("_start") + F.row_number().over(W.partitionBy(*group).orderBy("size", F.col(f"row.`{key}`")))
    crossed = F.floor(F.col("_step") * F.col("_place") + F.col("_offset")) - F.floor(
        F.col("_step") * (F.col("_place") - 1) + F.col("_offset")
    )
    return (
        rows.join(starts, group)
        .withColumns({"_place": place, "_step": step, "_offset": offset})
        .select("row", "size", "source_size", "target", F.least(crossed, F.ceil("_step")).cast("long").alias("copies"))
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))).select("row.*")
