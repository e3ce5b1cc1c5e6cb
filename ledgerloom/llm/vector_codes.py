"""Product codes of vectors, in whole numbers only.

A vector becomes integers and is cut into equal parts.  Every part position has a codebook, and a part is
written as the index of its nearest entry.  Parts and entries are zero-padded to a power of two and
Walsh-Hadamard transformed; the transform multiplies every squared distance by the padded width, so
squared differences of coefficients, added up in sequency order, only grow towards the scaled distance.
An entry is out as soon as its running sum passes the whole distance of a first guess.  Sums, products
and the final division are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Integers beyond this are held at it, and errors at the largest long.
MOST = 1 << 62
MOST_LONG = (1 << 63) - 1
#: Rows worked on at a time in a task.
ROWS = 4096
#: A label is hot when it holds more than one row in so many; there are fewer hot labels than this.
HOT_SHARE = 1000


def sequency_order(width: int) -> np.ndarray:
    """Places of the Walsh functions in the fast transform's output, by number of sign changes (bit-reversed Gray code)."""
    bits = width.bit_length() - 1
    gray = np.arange(width) ^ (np.arange(width) >> 1)
    return sum(((gray >> b) & 1) << (bits - 1 - b) for b in range(bits)) + np.zeros(width, np.int64)


def transformed(parts: np.ndarray) -> np.ndarray:
    """Integer Walsh-Hadamard transform of each row, zero-padded to a power of two, in sequency order."""
    rows, size = parts.shape
    width = 1 << max(0, size - 1).bit_length()
    out = np.zeros((rows, width), parts.dtype)
    out[:, :size] = parts
    step = 1
    while step < width:
        pairs = out.reshape(rows, width // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
        step *= 2
    return out[:, sequency_order(width)]


def _in_one_word(largest: int, size: int) -> bool:
    """Whether no scaled distance between parts with components up to ``largest`` leaves 63 bits."""
    width = 1 << max(0, size - 1).bit_length()
    return 4 * largest * largest * width * max(1, size) < 1 << 63


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part, the index of the nearest entry (ties to the lower one) and the squared distance."""
    largest = max((int(abs(x).max()) for x in (parts, entries) if x.size), default=0)
    kind = np.int64 if _in_one_word(largest, parts.shape[1]) else object
    a, b = transformed(parts.astype(kind)), transformed(entries.astype(kind))
    width = a.shape[1]
    at = max(1, width // 4)
    head = ((a[:, None, :at] - b[None, :, :at]) ** 2).sum(2)
    guess = head.argmin(1)
    bound = ((a - b[guess]) ** 2).sum(1)
    row, entry = np.nonzero(head <= bound[:, None])
    so_far = head[row, entry]
    while at < width:
        stop = min(width, 2 * at)
        so_far = so_far + ((a[row, at:stop] - b[entry, at:stop]) ** 2).sum(1)
        stays = so_far <= bound[row]
        row, entry, so_far, at = row[stays], entry[stays], so_far[stays], stop
    # The guess itself is never out, so every row is left with one entry at least, and entries ascend.
    best = np.minimum.reduceat(so_far, np.searchsorted(row, np.arange(len(a)))) if len(a) else bound
    hit = so_far == best[row]
    _, first = np.unique(row[hit], return_index=True)
    return entry[hit][first], best // width


def _finite(vector: Column) -> Column:
    """Whether a vector is there and has finite components only."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _whole(x: float) -> int:
    exact = math.floor(x) * SCALE if abs(x) > 1 << 53 else math.floor(x * SCALE)
    return max(-MOST, min(MOST, exact))


def integer_vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are kept, and their integers as rows of ``size`` (zeros behind a shorter vector)."""
    lengths = np.asarray(column.value_lengths().fill_null(0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    owner = np.repeat(np.arange(len(column)), lengths)
    fine = np.asarray(column.is_valid())
    fine[owner[~np.isfinite(values)]] = False
    kept = np.flatnonzero(fine)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(column), size), np.int64)
    held = fine[owner]
    owner, place, values = owner[held], place[held], values[held]
    large = np.abs(values) > MOST // (2 * SCALE)
    values, huge = np.where(large, 0.0, values), values[large]
    out[owner, place] = np.floor(values * SCALE).astype(np.int64)
    out[owner[large], place[large]] = [_whole(x) for x in huge.tolist()]
    return kept, out[kept]


def _runs(batch: pa.RecordBatch, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for a in range(0, batch.num_rows, ROWS):
        piece = batch.slice(a, ROWS)
        yield piece, *integer_vectors(piece.column("embedding"), size)


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: each entry becomes the floor of the mean of its parts, unused ones stay."""
    parts, entries, size = books.shape

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, size), object), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, _, rows in _runs(batch, parts * size):
                for j in range(parts):
                    part = rows[:, j * size : (j + 1) * size]
                    chosen, _ = nearest(part, books[j])
                    counts[j] += np.bincount(chosen, minlength=entries)
                    # No sum of ROWS components below 2**50 leaves 63 bits.
                    wide = part if not part.size or np.abs(part).max() < 1 << 50 else part.astype(object)
                    for e in np.unique(chosen):
                        sums[j, e] += wide[chosen == e].sum(0)
        used = np.argwhere(counts > 0)
        if len(used):
            exact = [[Decimal(int(x)) for x in sums[j, e]] for j, e in used]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used[:, 0], pa.int32()),
                    pa.array(used[:, 1], pa.int32()),
                    pa.array(counts[used[:, 0], used[:, 1]], pa.int64()),
                    pa.array(exact, pa.list_(pa.decimal128(38, 0))),
                ],
                ["part", "entry", "n", "sums"],
            )

    per_task = vectors.select("embedding").mapInArrow(totals, "part int, entry int, n bigint, sums array<decimal(38,0)>")
    added = (
        per_task.select("part", "entry", "n", F.posexplode("sums").alias("place", "total"))
        .groupBy("part", "entry", "place")
        .agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    )
    moved = books.copy()
    for r in added.collect():  # one number per component of the codebooks at most
        moved[r.part, r.entry, r.place] = int(r.total) // r.n
    return moved


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) learned from all kept ``vectors`` (vec_id, embedding).

    They start as the parts of the rows with the smallest ids (null ids last, rows of one id by their components); fewer rows
    give fewer entries, an empty table none.
    """
    kept = vectors.select("vec_id", "embedding").where(_finite(F.col("embedding")))
    longest = kept.agg(F.max(F.size("embedding"))).first()[0] or 0
    size = max(1, -(-longest // parts))
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    column = pa.array([list(r.embedding) for r in first], pa.list_(pa.float64()))
    _, rows = integer_vectors(column, parts * size)
    books = np.stack([rows[:, j * size : (j + 1) * size] for j in range(parts)])
    for _ in range(rounds if len(first) else 0):
        books = _moved(vectors, books)
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, with commas between them."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id, label, code, error`` of every kept vector under given codebooks."""
    parts, _, size = books.shape
    fields = [T.StructField(n, vectors.schema[n].dataType) for n in ("vec_id", "label")]
    out = T.StructType([*fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, kept, rows in _runs(batch, parts * size):
                if not len(kept):
                    continue
                codes, error = np.zeros((len(kept), parts), np.uint8), np.zeros(len(kept), object)
                for j in range(parts):
                    chosen, distance = nearest(rows[:, j * size : (j + 1) * size], books[j])
                    codes[:, j] = chosen
                    error += distance
                taken = piece.take(pa.array(kept))
                held = [min(MOST_LONG, int(x)) for x in error]
                columns = [taken.column("vec_id"), taken.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(held, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "code", "error"])

    return vectors.select("vec_id", "label", "embedding").mapInArrow(encode, out)


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Codes with ``label_error``, the error summed over all rows of the same label (nulls are one label).

    Errors are summed before the shuffle.  Sums of labels with more than one row in a thousand, fewer than a thousand, go to
    their rows by broadcast; all others meet their rows in a join that no label can fill alone.
    """
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(Decimal(MOST_LONG))).cast("bigint")
    sums = codes.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error"), F.count("*").alias("_n"))
    hot_rows = F.col("_n") * HOT_SHARE > codes.agg(F.count("*")).scalar()
    same = F.col("label").eqNullSafe(F.col("_label"))
    hot = F.broadcast(sums.where(hot_rows))
    rest = codes.join(hot, same, "left_anti").join(sums.where(~hot_rows), same)
    return codes.join(hot, same).unionByName(rest).drop("_label", "_n")


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row of ``vectors`` (vec_id, embedding, label).

    A vector that is null or holds a null, NaN or infinite component is left out; all other rows give one row each, repeated rows
    and null ids too.  Components are ``floor(4096 * x)``, held within 2**62 either way.  All vectors are as wide as the longest one,
    rounded up to a multiple of ``parts``; shorter ones end in zeros.  ``code`` has two hex digits per part.  Errors stop at the
    largest long.  An empty table, or one without a kept row, gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    books = fit(vectors, parts, entries, rounds)
    path = scratch_path(spark, "codes")
    codes = coded(vectors, books)
    codes.write.parquet(path)
    stored = spark.read.schema(codes.schema).parquet(path)
    return with_label_errors(stored).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
