"""Uniform shuffle into shards of exact size through a hypergeometric communication matrix.

How many rows every partition sends to every block is drawn first, on the driver, from
counts alone: row by row, multivariate hypergeometric in the room that is left.  Rows are
then permuted inside their partition, dealt out by the drawn counts, exchanged once and
permuted again inside their block.  Every arrangement is equally likely, and shard sizes
are exact.  A shard is a run of blocks, so no task ever holds a whole shard.

Tasks stream: Spark sorts by a random key (spilling where needed), Python only counts
along the sorted rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARDS = 8
#: Partitions and blocks at least and at most, and the rows that one of them is to hold in between.  The driver holds the
#: matrix, 4 million numbers at most.
LEAST_TASKS = 128
MOST_TASKS = 2048
TASK_ROWS = 1_000_000
SEED = 9
#: numpy draws hypergeometric counts below 10**9 rows; above this the law is summed up around its mode.
REGION_ROWS = 500_000_000


def split_evenly(total: int, parts: int) -> np.ndarray:
    """``total`` in ``parts`` whole numbers that are at most one apart."""
    return np.full(parts, total // parts, np.int64) + (np.arange(parts) < total % parts)


def task_count(rows: int) -> int:
    """Tasks of ``TASK_ROWS`` rows, within bounds."""
    return min(MOST_TASKS, max(LEAST_TASKS, -(-rows // TASK_ROWS)))


def draw_of_many(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """A hypergeometric count for any total: the law's ratios summed over 12 deviations on both sides of the mode."""
    least, most, total = max(0, drawn - bad), min(good, drawn), good + bad
    if least == most:
        return least
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), least), most)
    reach = 20 + int(12 * (drawn * (good / total) * (bad / total) * ((total - drawn) / max(1, total - 1))) ** 0.5)
    low, high = max(least, mode - reach), min(most, mode + reach)
    x = np.arange(low, high, dtype=np.float64)
    ratio = np.log(good - x) + np.log(drawn - x) - np.log(x + 1) - np.log(bad - drawn + x + 1)
    law = np.concatenate([[0.0], np.cumsum(ratio)])
    law = np.cumsum(np.exp(law - law.max()))
    return low + int(np.searchsorted(law, rng.random() * law[-1], side="right"))


def communication_matrix(counts: np.ndarray, room: np.ndarray, seed: int, region_rows: int = REGION_ROWS) -> np.ndarray:
    """Rows that each partition sends to each block; row sums ``counts``, column sums ``room``.

    Every partition draws from all room that is left, by one law at every size; only how a
    count is drawn changes above ``region_rows`` rows.
    """
    rng = np.random.default_rng(seed)
    matrix = np.zeros((len(counts), len(room)), np.int64)
    left = room.astype(np.int64)
    for i, count in enumerate(counts):
        if left.sum() <= region_rows:
            matrix[i] = rng.multivariate_hypergeometric(left, int(count), method="marginals")
        else:
            drawn, others = int(count), int(left.sum())
            for j, good in enumerate(left.tolist()):
                others -= good
                matrix[i, j] = draw_of_many(rng, good, others, drawn)
                drawn -= int(matrix[i, j])
        left = left - matrix[i]
    return matrix


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(values)) + 1
    yield from zip([0, *edges], [*edges, len(values)], strict=True)


def shuffle_into_shards(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    partitions: int | None = None,
    blocks: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``row`` (all columns of a document), ``shard`` and ``slot``; shard sizes are at most one apart.

    Slots of a shard count from 0 without a gap.  Null keys and texts, empty texts and
    repeated rows are rows like any other; the columns of ``docs`` sit in one struct, so
    no name can clash.  An empty table gives an empty result.  The same rows and seed give
    the same result, up to rows with equal key and text.  Unless given, ``partitions`` and the blocks of all
    shards follow the number of rows (:func:`task_count`).  The driver holds ``partitions * shards * blocks`` counts.
    """
    tasks = task_count(docs.count()) if partitions is None or blocks is None else 0
    partitions, blocks = partitions or tasks, blocks or -(-tasks // shards)
    mark = [F.lit(seed), F.col(f"row.`{key}`"), F.xxhash64(F.col(f"row.`{text}`"))]
    rows = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
        .withColumn("part", F.pmod(F.xxhash64(*mark), F.lit(partitions)).cast("int"))
        .withColumns({"first": F.xxhash64(F.lit("first"), *mark), "second": F.xxhash64(F.lit("second"), *mark)})
    )
    counts = np.zeros(partitions, np.int64)
    for part, n in rows.groupBy("part").count().collect():
        counts[part] = n
    sizes = split_evenly(int(counts.sum()), shards)
    room = np.concatenate([split_evenly(int(n), blocks) for n in sizes])
    ends = communication_matrix(counts, room, seed).cumsum(axis=1)
    starts = np.concatenate([np.cumsum(x) - x for x in room.reshape(shards, blocks)])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part").to_numpy(zero_copy_only=False)
            block = np.empty(len(part), np.int32)
            for a, b in _runs(part):
                at = seen.get(part[a], 0)
                block[a:b] = np.searchsorted(ends[part[a]], np.arange(at, at + b - a), side="right")
                seen[part[a]] = at + b - a
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("second"), pa.array(block)], ["row", "second", "block"])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            block = batch.column("block").to_numpy(zero_copy_only=False)
            slot = np.empty(len(block), np.int64)
            for a, b in _runs(block):
                at = seen.get(block[a], 0)
                slot[a:b] = starts[block[a]] + np.arange(at, at + b - a)
                seen[block[a]] = at + b - a
            shard = pa.array((block // blocks).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("row"), shard, pa.array(slot)], ["row", "shard", "slot"])

    row = rows.schema["row"].dataType.simpleString()
    sent = rows.repartition(partitions, "part").sortWithinPartitions("part", "first")
    sent = sent.mapInArrow(dealt, f"row {row}, second bigint, block int")
    held = sent.repartition(shards * blocks, "block").sortWithinPartitions("block", "second")
    return held.mapInArrow(placed, f"row {row}, shard int, slot bigint")
