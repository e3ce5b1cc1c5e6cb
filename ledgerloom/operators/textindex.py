"""Fuzzy lookup through a stored q-gram index: the same rows as scoring everything, few of them scored.

Two texts at edit distance ``d`` differ in length by ``d`` at most and share all but ``d * q`` of their runs of ``q``
characters.  Lengths and shared runs therefore bound the likeness of every row from above without its text.  The rows
with the highest bounds are scored first; the last place among them is a score to beat, and only rows whose bound
reaches it are scored at all.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import edit_similarity
from ledgerloom.session import set_for

GRAM = 3
BUCKETS = 64
#: Bytes of shuffled runs that a task should write, about ten times that in its memory.
WRITE_BYTES = 16 << 20
#: Rows scored first, as a multiple of the places asked for.
FIRST_LOOK = 4


def grams(text: Column, q: int = GRAM) -> Column:
    """All runs of ``q`` characters of a text, repeats included.

    A character outside the basic plane may add a run that starts inside it; more shared runs only loosen a bound.
    """
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1))


def question_grams(question: str, q: int = GRAM) -> dict[str, int]:
    return dict(Counter(question[i : i + q] for i in range(len(question) - q + 1)))


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def counted_grams(text: Column, q: int = GRAM) -> Column:
    """The different runs of a text with their counts, as ``gram, n``; null for a null text.

    Equal runs stand together in the sorted list of all runs, so a text is counted by itself: no row waits for others.
    """

    def firsts(every: Column) -> Column:
        placed = F.transform(every, lambda gram, i: F.struct(gram.alias("gram"), i.alias("at")))
        return F.filter(placed, lambda x: ~x["gram"].eqNullSafe(F.get(every, x["at"] - 1)))

    def counts(every: Column, first: Column) -> Column:
        end = lambda j: F.coalesce(F.get(first, j + 1)["at"], F.size(every))
        return F.transform(first, lambda x, j: F.struct(x["gram"].alias("gram"), (end(j) - x["at"]).alias("n")))

    # A list of one, so that what it holds is worked out once however often it is used.
    nested = F.transform(F.array(F.sort_array(grams(text, q))), lambda every: F.get(F.transform(F.array(firsts(every)), lambda first: counts(every, first)), 0))
    return F.get(nested, 0)


def store_gram_index(df: DataFrame, text: str, path: str, q: int = GRAM, buckets: int = BUCKETS) -> None:
    """Rows of ``df`` in order of text length below ``path/rows``, their runs with counts below ``path/grams``.

    Rows get an id when they are stored, and the runs are taken from the stored rows.  Runs are dealt to directories by a hash, so
    a lookup opens the directories of its own runs only; a frequent run is written by several tasks.  Null texts have a
    null length and no runs.

    Runs shrink about tenfold in a shuffle, and a task that writes them sorts its part by directory: the parts are
    cut near ``WRITE_BYTES`` of the shuffle, but never inside what one task sends to a shuffle partition.  With as many
    shuffle partitions as directories, no task sorts on the way there.
    """
    length = F.length(text)
    ordered = df.withColumn("_length", length).repartitionByRange("_length", F.monotonically_increasing_id())
    ordered.sortWithinPartitions("_length").withColumn("_row", F.monotonically_increasing_id()).write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.parquet(f"{path}/rows")
    counted = rows.select("_row", F.inline(counted_grams(F.col(text), q)))
    dealt = counted.withColumn("bucket", _bucket(F.col("gram"), buckets)).hint("rebalance", buckets, "bucket")
    with set_for(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(WRITE_BYTES)}):
        dealt.write.partitionBy("bucket").option("maxRecordsPerFile", 50_000_000).parquet(f"{path}/grams")


class GramIndex:
    """A stored index; ``q`` and ``buckets`` are those it was stored with."""

    def __init__(self, spark: SparkSession, path: str, text: str, q: int = GRAM, buckets: int = BUCKETS):
        self.rows = spark.read.parquet(f"{path}/rows")
        # Null and very short texts alone leave no runs behind, and no directory to read.
        self.grams = spark.read.schema("_row bigint, gram string, n int, bucket int").option("basePath", f"{path}/grams").parquet(f"{path}/grams")
        self.text, self.q, self.buckets = text, q, buckets

    def shared(self, questions: list[str]) -> DataFrame:
        """``_row, shared_0, ...``: runs that a row has in common with each question, for rows with any."""
        asked = [question_grams(question, self.q) for question in questions]
        every = sorted(set().union(*asked))
        spark = self.rows.sparkSession
        listed = spark.range(1).select(F.explode(F.array(*map(F.lit, every)) if every else F.array().cast("array<string>")).alias("gram"))
        buckets = [r.b for r in listed.select(_bucket(F.col("gram"), self.buckets).alias("b")).distinct().collect()]
        postings = self.grams.where(F.col("bucket").isin(buckets) & F.col("gram").isin(every))
        overlap = [_overlap(own).alias(f"shared_{i}") for i, own in enumerate(asked)]
        return postings.groupBy("_row").agg(*overlap)

    def bounds(self, questions: list[str]) -> DataFrame:
        """``_row, number, bound`` for every row and question: no text of the row can score higher; null for a null text."""
        entries = []
        for i, question in enumerate(questions):
            longest = F.greatest("_length", F.lit(len(question)))
            shared = F.coalesce(F.col(f"shared_{i}"), F.lit(0))
            missing = F.ceil((longest - (self.q - 1) - shared) / F.lit(self.q))
            least = F.greatest(F.abs(F.col("_length") - len(question)), missing, F.lit(0))
            bound = F.when(F.col("_length").isNull(), F.lit(None).cast("double")).when(longest == 0, F.lit(1.0)).otherwise(F.lit(1.0) - least / longest)
            entries.append(F.struct(F.lit(i).alias("number"), bound.alias("bound")))
        joined = self.rows.select("_row", "_length").join(self.shared(questions), "_row", "left")
        return joined.select("_row", F.inline(F.array(*entries)))

    def _scored(self, wanted: DataFrame, questions: list[str]) -> DataFrame:
        """The rows of ``wanted`` (_row, number) with ``question`` and ``score``."""
        score = F.lit(None).cast("double")
        for i, question in enumerate(questions):
            score = F.when(F.col("number") == i, edit_similarity(self.text, question)).otherwise(score)
        named = F.element_at(F.array(*map(F.lit, questions)), F.col("number") + 1)
        return self.rows.join(wanted, "_row").withColumns({"question": named, "score": score})

    def to_score(self, questions: list[str], top: int) -> DataFrame:
        """``_row, number`` of the rows that may take one of the first ``top`` places of a question.

        Two passes: the rows with the highest bounds are scored, and the score of their last place is what others must reach.  The
        driver learns one number per question.  Where there are fewer texts than places, all rows may take one.
        """
        bounds = self.bounds(questions)
        highest = Window.partitionBy("number").orderBy(F.desc_nulls_last("bound"), "_row")
        first = bounds.withColumn("place", F.row_number().over(highest)).where(F.col("place") <= FIRST_LOOK * top)
        best = Window.partitionBy("number").orderBy(F.desc_nulls_last("score"))
        looked = self._scored(first.select("_row", "number"), questions).withColumn("place", F.row_number().over(best))
        last = {r.number: r.score for r in looked.where(F.col("place") == top).select("number", "score").collect()}
        reached = F.lit(False)
        for i in range(len(questions)):
            enough = F.lit(True) if last.get(i) is None else F.col("bound") >= F.lit(last[i])
            reached = F.when(F.col("number") == i, enough).otherwise(reached)
        return bounds.where(reached).select("_row", "number")

    def closest_each(self, questions: list[str], top: int = 10, tie_break: list[str] | None = None) -> DataFrame:
        """What :func:`ledgerloom.operators.textmatch.closest_each` gives for the indexed rows."""
        best = Window.partitionBy("question").orderBy(F.desc_nulls_last("score"), *(tie_break or []))
        scored = self._scored(self.to_score(questions, top), questions)
        placed = scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
        return placed.drop("_row", "_length", "number")

    def closest(self, question: str, top: int = 10, tie_break: list[str] | None = None) -> DataFrame:
        """What :func:`ledgerloom.operators.textmatch.closest` gives for the indexed rows."""
        scored = self._scored(self.to_score([question], top), [question])
        return scored.orderBy(F.desc_nulls_last("score"), *(tie_break or [])).limit(top).drop("_row", "_length", "number", "question")

    def effort(self, questions: list[str], top: int = 10) -> DataFrame:
        """``question, rows, scored``: how many of the rows a lookup scores after its first look."""
        named = F.element_at(F.array(*map(F.lit, questions)), F.col("number") + 1)
        scored = self.to_score(questions, top).groupBy(named.alias("question")).agg(F.count("*").alias("scored"))
        asked = self.rows.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, questions))).alias("question"))
        rows = self.rows.agg(F.count("*").alias("rows")).scalar()
        return asked.join(scored, "question", "left").select("question", rows.alias("rows"), F.coalesce("scored", F.lit(0)).alias("scored"))


def _overlap(own: dict[str, int]) -> Column:
    """Runs of one question that a row shares, each as often as both have it."""
    if not own:
        return F.lit(0).cast("bigint")
    counts = F.create_map(*[x for gram, n in own.items() for x in (F.lit(gram), F.lit(n))])
    return F.sum(F.coalesce(F.least("n", F.try_element_at(counts, F.col("gram"))), F.lit(0)))
