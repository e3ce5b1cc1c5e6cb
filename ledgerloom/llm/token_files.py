"""Token files: ids in patched frame-of-reference blocks.

Documents are put in order of their ids, tokenized once, and written as files of blocks.  A block subtracts its
smallest id, packs the differences at the width that most of them need, and lists the few that need more with
their places.  The index behind the blocks says where each block starts, which id it starts with, and how long
each document is, so that any run of ids is read from its own blocks.

A file, all numbers little-endian::

    blocks          BLOCK_HEAD, then 16 * width words of 64 bits, then the places (16 bits) and the
                    differences (32 bits) of the outliers; 0x0A behind every run of blocks
    index           start of each block in the file, first id of each block in the file, document
                    ids, lengths (64 bits each), and a byte per document that is 1 for a null id
    tail            TAIL, 0x0A

In a block, value ``16 * i + lane`` stands in lane ``lane`` at bit ``i * width``; word ``k`` of all lanes comes
before word ``k + 1``.  Spark writes the files through its text writer, so they land in any store that it
knows, and its commit keeps files of lost tasks out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.memory import release
from ledgerloom.llm.tokens import default_tokenizer, shared_tokenizer

END = 2
BLOCK = 1024
LANES = BLOCK // 64
#: The width of a block is what so many of its differences, in a hundred, fit in.
PERCENTILE = 95
#: Blocks packed at a time.
TOGETHER = 512
BLOCK_HEAD = np.dtype([("least", "<u4"), ("count", "<u2"), ("outliers", "<u2"), ("width", "u1")])
MAGIC = b"PFORTOK1"
TAIL = np.dtype([("part", "<u4"), ("section", "<u4"), ("blocks", "<u8"), ("documents", "<u8"), ("ids", "<u8"), ("index", "<u8"), ("magic", "S8")])
#: Text behind one task, and runs of blocks in one file (8 MB of text or one longer document each).
TASK_BYTES = 64 << 20
RUNS = 8


def bit_width(values: np.ndarray) -> np.ndarray:
    """Bits that each non-negative number below 2**53 needs."""
    return np.frexp(values.astype(np.float64))[1]


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``BLOCK`` numbers below ``2**width`` as rows of ``LANES * width`` words."""
    rows = values.astype(np.uint64).reshape(len(values), 64, LANES)
    out = np.zeros((len(values), width, LANES), np.uint64)
    for i in range(64 if width else 0):
        word, bit = divmod(i * width, 64)
        out[:, word] |= rows[:, i] << np.uint64(bit)
        if bit + width > 64:
            out[:, word + 1] |= rows[:, i] >> np.uint64(64 - bit)
    return out.reshape(len(values), LANES * width)


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    """The numbers that :func:`pack` packed."""
    rows = words.reshape(len(words), width, LANES)
    out = np.zeros((len(words), 64, LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for i in range(64 if width else 0):
        word, bit = divmod(i * width, 64)
        value = rows[:, word] >> np.uint64(bit)
        if bit + width > 64:
            value = value | rows[:, word + 1] << np.uint64(64 - bit)
        out[:, i] = value & mask
    return out.reshape(len(words), BLOCK)


def encode_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Blocks of a run of ids, the start of each block in the bytes, and its first id's place in the run."""
    pieces = [p for a in range(0, len(ids), TOGETHER * BLOCK) for p in _blocks(ids[a : a + TOGETHER * BLOCK])]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces], dtype=np.int64)])[:-1]
    return b"".join(pieces), starts.astype(np.int64), np.arange(len(pieces), dtype=np.int64) * BLOCK


def _blocks(ids: np.ndarray) -> list[bytes]:
    blocks = -(-len(ids) // BLOCK)
    count = np.full(blocks, BLOCK, np.int64)
    count[blocks - 1 :] = len(ids) - BLOCK * (blocks - 1)
    filled = np.full(blocks * BLOCK, ids[-1], np.uint32)
    filled[: len(ids)] = ids
    grid = filled.reshape(blocks, BLOCK)
    least = grid.min(1)
    grid = grid - least[:, None]
    at = -(-BLOCK * PERCENTILE // 100) - 1
    width = bit_width(np.partition(grid, at, axis=1)[:, at])
    over = (grid >> np.minimum(width, 31).astype(np.uint32)[:, None]) != 0
    over &= (width < 32)[:, None]
    over &= np.arange(BLOCK) < count[:, None]
    row, place = np.nonzero(over)
    patches = np.bincount(row, minlength=blocks)
    head = np.zeros(blocks, BLOCK_HEAD)
    head["least"], head["count"], head["outliers"], head["width"] = least, count, patches, width
    low = np.where(over, 0, grid).astype(np.uint32)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width).tolist():
        some = np.flatnonzero(width == w)
        raw, size = pack(low[some] & np.uint32((1 << w) - 1), w).astype("<u8").tobytes(), LANES * w * 8
        for k, b in enumerate(some.tolist()):
            packed[b] = raw[k * size : (k + 1) * size]
    heads, places, values = head.tobytes(), place.astype("<u2").tobytes(), grid[row, place].astype("<u4").tobytes()
    cut, step = np.concatenate([[0], np.cumsum(patches)]).tolist(), BLOCK_HEAD.itemsize
    return [
        heads[b * step : (b + 1) * step] + packed[b] + places[2 * cut[b] : 2 * cut[b + 1]] + values[4 * cut[b] : 4 * cut[b + 1]]
        for b in range(blocks)
    ]


def _gathered(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after the other."""
    before = np.cumsum(sizes) - sizes
    return data[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


def decode_blocks(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks at ``starts``, in that order."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    head = data[starts[:, None] + np.arange(BLOCK_HEAD.itemsize)].copy().view(BLOCK_HEAD)[:, 0]
    width, body = head["width"].astype(np.int64), starts + BLOCK_HEAD.itemsize
    grid = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]).tolist():
        some = np.flatnonzero(width == w)
        words = data[body[some][:, None] + np.arange(LANES * w * 8)].copy().view("<u8")
        grid[some] = unpack(words, w)
    patches = head["outliers"].astype(np.int64)
    places = body + LANES * 8 * width
    row = np.repeat(np.arange(len(starts)), patches)
    at = _gathered(data, places, 2 * patches).copy().view("<u2")
    grid[row, at] = _gathered(data, places + 2 * patches, 4 * patches).copy().view("<u4")
    grid += head["least"][:, None]
    return grid[np.arange(BLOCK) < head["count"][:, None]]


class TokenFile:
    """A file's index; ids are decoded from the blocks that hold them."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        tail = np.frombuffer(data, TAIL, 1, len(data) - 1 - TAIL.itemsize)[0]
        if tail["magic"] != MAGIC or data[-1:] != b"\n":
            raise ValueError("not a token file")
        self.key, self.size = (int(tail["part"]), int(tail["section"])), int(tail["ids"])
        at, columns = int(tail["index"]), []
        for count in (tail["blocks"], tail["blocks"], tail["documents"], tail["documents"]):
            columns.append(np.frombuffer(data, "<i8", int(count), at))
            at += 8 * int(count)
        self.starts, self.first, self.documents, self.lengths = columns
        self.null = np.frombuffer(data, np.uint8, len(self.documents), at).astype(bool)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` to before ``stop``, counted in this file."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.first, start, "right") - 1, np.searchsorted(self.first, stop, "left")
        return decode_blocks(self.data, self.starts[a:b])[start - self.first[a] : stop - self.first[a]]


class _Section:
    """One file while it is made: runs of blocks, then the index."""

    def __init__(self, part: int, number: int):
        self.part, self.number, self.bytes, self.size, self.runs = part, number, 0, 0, 0
        self.starts, self.first, self.documents, self.lengths = [], [], [], []

    def run(self, documents: pa.Array, ids: list[np.ndarray]) -> bytes:
        data, starts, first = encode_blocks(np.concatenate(ids))
        self.starts.append(starts + self.bytes)
        self.first.append(first + self.size)
        self.documents.append(documents)
        self.lengths.extend(map(len, ids))
        self.bytes += len(data) + 1
        self.size += sum(map(len, ids))
        self.runs += 1
        return data

    def index(self) -> bytes:
        documents = pa.concat_arrays(self.documents)
        tail = np.zeros(1, TAIL)
        starts = np.concatenate(self.starts)
        tail[0] = (self.part, self.number, len(starts), len(documents), self.size, self.bytes, MAGIC)
        columns = [starts, np.concatenate(self.first), documents.fill_null(0).to_numpy(), np.array(self.lengths, np.int64)]
        null = np.asarray(documents.is_null()).astype(np.uint8)
        return b"".join([*(c.astype("<i8").tobytes() for c in columns), null.tobytes(), tail.tobytes()])


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END, task_bytes: int = TASK_BYTES) -> None:
    """Token files of ``docs`` (doc_id, text) below ``path``, in ascending order of doc_id.

    Null and empty texts are the end mark alone.  Null ids come last; rows of one id are all written, in order of a hash of
    their text, and tasks are cut between such rows too, so that no id fills one task.  A document is never cut: a very
    long one makes its file longer.  An empty table leaves a folder without files; other columns are not read.
    """
    name = tokenizer or default_tokenizer()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, tail = shared_tokenizer(name), np.array([end], np.uint32)
        section = _Section(TaskContext.get().partitionId(), 0)
        row = lambda data: pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["value"])
        for batch in batches:
            for a, run in words.encode(batch.column("text")):
                yield row(section.run(batch.column("doc_id").slice(a, len(run)), [np.concatenate([x, tail]) for x in run]))
                if section.runs == RUNS:
                    yield row(section.index())
                    section = _Section(section.part, section.number + 1)
            release()
        if section.runs:
            # A file has RUNS + 1 rows, but for a task's last one.
            yield row(section.index())
        release()

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("mark"), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_last("doc_id"), F.col("mark"), F.col("row")]
    ordered = keyed.repartitionByRange(max(1, -(-total // task_bytes)), *order).sortWithinPartitions(*order)
    made = ordered.select("doc_id", "text").mapInArrow(write, "value binary")
    made.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", RUNS + 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("content")


def _token_files(batch: pa.RecordBatch) -> Iterator[TokenFile]:
    return (TokenFile(x.as_py()) for x in batch.column("content"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document below ``path``.

    ``ids`` holds little-endian 32-bit numbers with the end mark; ``start`` counts the ids of all documents before it.  The
    driver learns one number per file.
    """

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(*f.key, f.size) for f in _token_files(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*made, strict=True)] or [pa.nulls(0, pa.int64())] * 3, ["part", "section", "n"])

    base, before = {}, 0
    for part, section, n in sorted(map(tuple, _files(spark, path).mapInArrow(sizes, "part bigint, section bigint, n bigint").collect())):
        base[part, section] = before
        before += n

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in _token_files(batch):
                ends = np.cumsum(file.lengths)
                starts, a = ends - file.lengths, 0
                while a < len(ends):  # about a million ids at a time
                    b = max(a + 1, int(np.searchsorted(ends, starts[a] + (1 << 20), "right")))
                    raw = file.ids(int(starts[a]), int(ends[b - 1])).astype("<u4").tobytes()
                    cut = (4 * (np.concatenate([starts[a:b], ends[b - 1 : b]]) - starts[a])).tolist()
                    ids = pa.array([raw[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                    names = pa.array(file.documents[a:b], pa.int64(), mask=file.null[a:b])
                    columns = [names, pa.array(starts[a:b] + base[file.key], pa.int64()), pa.array(file.lengths[a:b], pa.int64()), ids]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
                    a = b

    return _files(spark, path).mapInArrow(documents, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
