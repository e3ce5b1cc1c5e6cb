"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order: rarer first, by exact counts over all documents.  A
pair that is similar enough shares an n-gram early in that order, in each document's
prefix; how early bounds how much it can share in all.  Candidate pairs come from equal
n-grams in prefixes.  The order is cut into fragments; a document's n-grams fall into
segments, one per fragment.  Overlaps are counted fragment by fragment and summed per pair.

Only connectivity is asked for, so pairs come in two steps.  First every document of a
list (the documents with one n-gram in their prefix) is compared with the list's leader,
the one with the fewest rare n-grams.  Then all pairs of a list whose documents are not yet
connected are compared.  What is skipped is connected already, so no group is lost.

Documents with equal n-gram sets are one class all along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import blocks, rolling
from ledgerloom.llm.memory import lean
from ledgerloom.session import scratch_path

N = 5
PERCENT = 80
OUT = "kind string, doc_id bigint, class bigint, n int, gram bigint, left int, fragment int, grams array<bigint>"


def _classes(table: pa.Table, n: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """A block's distinct sets, and each document's class and set size.  Class 0 is the empty set."""
    seen: dict[int, int] = {}
    sets: list[np.ndarray] = []
    marks = np.zeros(table.num_rows, np.uint64)
    sizes = np.zeros(table.num_rows, np.int64)
    at = 0
    for _, found in rolling.shingles(table.column("text"), n):
        for grams in found:
            if len(grams):
                mark = rolling.mixed(np.array([rolling.mixed(grams).sum() + np.uint64(len(grams))], np.uint64))[0] | np.uint64(1)
                marks[at], sizes[at] = mark, len(grams)
                if mark not in seen:
                    seen[mark] = len(sets)
                    sets.append(grams)
            at += 1
    return sets, marks, sizes


def fragment_of(times: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Fragments of the global order (count, then hash): four of n-grams found up to three times, two up to 15, two above."""
    top = grams >> np.uint64(62)
    rest = 4 + 2 * (times >= 16) + (top >> np.uint64(1)).astype(np.int64)
    return np.where(times < 4, top.astype(np.int64), rest)


def _least(n: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of a set of this size with any set similar enough."""
    return -(-n * percent // 100)


def class_table(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Documents with their classes, prefix entries, and segments, told apart by ``kind``."""
    count = blocks.block_count(docs)
    texts = blocks.blocked(docs, count)

    def features(table: pa.Table) -> np.ndarray:
        sets, *_ = _classes(table, n)
        return np.concatenate(sets) if sets else np.zeros(0, np.uint64)

    @lean
    def prepared(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets, marks, sizes = _classes(table, n)
        ids = table.column("doc_id")
        docs_out = {"kind": ["doc"] * len(ids), "doc_id": ids.to_pylist(), "class": marks.view(np.int64), "n": sizes}
        parts = [_rows(docs_out)]
        if sets:
            length = np.array([len(s) for s in sets])
            grams = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), length)
            mark = np.fromiter(dict.fromkeys(marks[marks != 0]), np.uint64)
            times = blocks.times_of(grams, count, blocks.known(answers))
            keep = times >= 2
            grams, owner, times = grams[keep], owner[keep], times[keep]
            order = np.lexsort((grams, times, owner))
            grams, owner, times = grams[order], owner[order], times[order]
            first = np.searchsorted(owner, np.arange(len(sets)))
            shared = np.bincount(owner, minlength=len(sets))
            place = (length - shared)[owner] + np.arange(len(owner)) - first[owner]
            left = length[owner] - place
            early = left >= _least(length, percent)[owner]
            parts.append(_rows({"kind": ["entry"] * int(early.sum()), "class": mark[owner[early]].view(np.int64), "n": length[owner[early]], "gram": grams[early].view(np.int64), "left": left[early]}))
            wanted = np.zeros(len(sets), bool)
            wanted[owner[early]] = True
            kept = wanted[owner]
            grams, owner, times = grams[kept], owner[kept], times[kept]
            piece = fragment_of(times, grams)
            order = np.lexsort((piece, owner))
            grams, owner, piece = grams[order], owner[order], piece[order]
            edges = np.flatnonzero(np.r_[True, (np.diff(owner) != 0) | (np.diff(piece) != 0)]) if len(owner) else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[edges, len(grams)].astype(np.int32)), pa.array(grams.view(np.int64)))
            if len(edges):
                parts.append(_rows({"kind": ["segment"] * len(edges), "class": mark[owner[edges]].view(np.int64), "n": length[owner[edges]], "fragment": piece[edges], "grams": lists}))
        return pa.concat_tables(parts)

    answers = blocks.shared_features(texts, count, features)
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(prepared, OUT)


_TYPES = {"kind": pa.string(), "doc_id": pa.int64(), "class": pa.int64(), "n": pa.int32(), "gram": pa.int64(), "left": pa.int32(), "fragment": pa.int32(), "grams": pa.list_(pa.int64())}


def _rows(columns: dict) -> pa.Table:
    size = len(columns["kind"])
    made = {}
    for name, kind in _TYPES.items():
        x = columns.get(name)
        made[name] = pa.nulls(size, kind) if x is None else x if isinstance(x, pa.Array) else pa.array(x if isinstance(x, list) else x.astype(kind.to_pandas_dtype()), kind)
    return pa.table(made)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether the n-grams left from a shared one on can make two sets similar enough."""
    return (100 + percent) * F.least(f"{a}.left", f"{b}.left") >= percent * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(f"{a}.class", f"{b}.class").alias("a"), F.greatest(f"{a}.class", f"{b}.class").alias("b")]


def leader_pairs(entries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every class of a list with the list's leader."""
    rank = F.struct((F.col("left") / F.col("n")).alias("share"), "class", "left", "n")
    lists = entries.groupBy("gram").agg(F.max(rank).alias("x"), F.count("*").alias("size")).where("size > 1")
    leaders = lists.select("gram", "x.class", "x.left", "x.n")
    joined = entries.alias("e").join(leaders.alias("x"), "gram").where(F.col("e.class") != F.col("x.class"))
    return joined.where(_possible("e", "x", percent)).select(*_pair("e", "x")).distinct()


def crossing_pairs(entries: DataFrame, labels: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of a list whose classes are not connected yet; lists within one component are left out before pairing."""
    labelled = entries.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    open_lists = labelled.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("gram")
    inside = labelled.join(open_lists, "gram", "left_semi")
    a, b = inside.alias("a"), inside.alias("b")
    apart = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.label") < F.col("b.label")) & _possible("a", "b", percent)
    return a.join(b, apart).select(*_pair("a", "b")).distinct()


def similar(pairs: DataFrame, segments: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that are similar enough: overlaps counted in each fragment, summed per pair."""
    one = segments.select(F.col("class").alias("a"), "fragment", F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    two = segments.select(F.col("class").alias("b"), "fragment", F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))
    met = pairs.join(one, "a").join(two, ["b", "fragment"])
    overlap = F.size(F.array_intersect("grams_a", "grams_b")).alias("overlap")
    partial = met.select("a", "b", "n_a", "n_b", overlap)
    summed = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("overlap").alias("overlap"))
    return summed.where((100 + percent) * F.col("overlap") >= percent * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def connected(links: DataFrame, folder: str) -> DataFrame:
    """``class, label``: the smallest class reachable, for every class in ``links``.

    Labels spread along links and then jump to their label's label, so a chain takes
    rounds in its logarithm.  Every round is a written table; nothing is collected but
    the count of labels that changed.
    """
    spark = links.sparkSession
    both = links.select(F.col("a").alias("class"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("class"), F.col("a").alias("other")))
    both.write.mode("overwrite").parquet(f"{folder}/edges")
    edges = spark.read.parquet(f"{folder}/edges")
    labels = edges.groupBy("class").agg(F.least("class", F.min("other")).alias("label"))
    at = 0
    while True:
        labels.write.mode("overwrite").parquet(f"{folder}/labels-{at}")
        labels = spark.read.parquet(f"{folder}/labels-{at}")
        heard = edges.join(labels.select(F.col("class").alias("other"), "label"), "other").groupBy("class").agg(F.min("label").alias("heard"))
        near = labels.join(heard, "class").select("class", F.col("label").alias("old"), F.least("label", "heard").alias("near"))
        jump = labels.select(F.col("class").alias("near"), F.col("label").alias("far"))
        moved = near.join(jump, "near").select("class", "old", F.least("near", "far").alias("label"))
        moved.write.mode("overwrite").parquet(f"{folder}/moved-{at}")
        moved = spark.read.parquet(f"{folder}/moved-{at}")
        if moved.where("old != label").isEmpty():
            return labels
        labels = moved.select("class", "label")
        at += 1


def near_duplicate_groups(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document.

    Words are compared in lower case (A to Z).  A text of fewer than ``n`` words is one
    n-gram; null, empty and blank texts have none and are linked with nothing.  Null
    ids take part, but only name a component where it has no other id; repeated rows are
    linked with each other.  An empty table gives an empty result, other columns are not
    read.  N-grams and classes are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngram-join")
    class_table(docs, n, percent).write.parquet(f"{folder}/classes")
    table = spark.read.schema(OUT).parquet(f"{folder}/classes")
    entries = table.where("kind = 'entry'").groupBy("gram", "class").agg(F.first("n").alias("n"), F.first("left").alias("left"))
    sizes = entries.groupBy("gram").agg(F.count("*").alias("size")).where("size > 1").select("gram")
    entries.join(sizes, "gram", "left_semi").write.parquet(f"{folder}/entries")
    entries = spark.read.parquet(f"{folder}/entries")
    segments = table.where("kind = 'segment'").dropDuplicates(["class", "fragment"]).select("class", "fragment", "n", "grams")
    similar(leader_pairs(entries, percent), segments, percent).write.parquet(f"{folder}/links-1")
    first = spark.read.parquet(f"{folder}/links-1")
    labels = connected(first, f"{folder}/first")
    similar(crossing_pairs(entries, labels, percent), segments, percent).write.parquet(f"{folder}/links-2")
    second = spark.read.parquet(f"{folder}/links-2")
    if not second.isEmpty():
        labels = connected(first.unionByName(second), f"{folder}/second")
    members = table.where("kind = 'doc'").select("doc_id", F.col("n").alias("n_shingles"), "class")
    named = members.groupBy("class").agg(F.min("doc_id").alias("least")).where("class != 0")
    named = named.join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    named = named.join(least, "label").select("class", "component_id")
    component = F.when(F.col("class") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return members.join(named, "class", "left").select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), component.alias("component_id"))


def first_of_each_group(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """The document with the smallest id of every group, with the columns of ``docs``; documents without words all stay.

    Rows that repeat an id and its text are one document.
    """
    groups = near_duplicate_groups(docs, n, percent)
    kept = groups.where("doc_id is null or doc_id = component_id").select("doc_id").distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select("doc_id", row)
    return rows.join(kept, "doc_id", "left_semi").unionByName(rows.where("doc_id is null")).select("row.*").dropDuplicates(["doc_id", "text"])
