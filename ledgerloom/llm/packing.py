"""Packing of documents into training sequences by lexical retrieval.

Documents are tokenized once into a shared table.  Document frequencies of all tokens are
counted over the whole corpus; the vocabulary bounds them.  Documents are dealt to shards
of about equal size, and every shard builds a BM25 inverted index of its own under the
corpus-wide statistics.  A seed document queries the index with its terms; its unused
neighbours fill its window in order of score.  The document that no longer fits is cut, and
its rest seeds the next window, so only a shard's last sequence is padded.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.memory import lean, release
from ledgerloom.llm.tokens import default_tokenizer, shared_tokenizer
from ledgerloom.session import scratch_path, set_for

WINDOW = 2048
END = 1
SHARD_TOKENS = 600_000
K1, B = 1.2, 0.75
SHARD_BITS = 32
#: Bytes of the batches that the tokenizer reads; a longer text is a batch of its own.
BATCH_BYTES = 4 << 20


def tokenized(docs: DataFrame, tokenizer: str, end: int = END) -> DataFrame:
    """``doc_id, ids, n`` per document (two-byte ids with the end mark), and one row per task with ``found``: in how many of its documents each token stands."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared_tokenizer(tokenizer)
        found = np.zeros(max(words.size, end + 1), np.int64)
        tail = np.array([end], "<u2")
        names = ["doc_id", "ids", "n", "found"]
        for batch in batches:
            for a, run in words.encode(batch.column("text")):
                ids = [np.concatenate([x, tail]) for x in run]
                for x in ids:
                    seen = np.sort(x)
                    found[seen[np.flatnonzero(seen[1:] != seen[:-1])]] += 1
                    found[seen[-1]] += 1
                columns = [batch.column("doc_id").slice(a, len(ids)), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.nulls(len(ids), pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names)
        release()
        counts = pa.array([found.tolist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.nulls(1, docs_id), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int64()), counts], names)

    docs_id = pa.int64()
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(encode, "doc_id bigint, ids binary, n bigint, found array<bigint>")


class Index:
    """BM25 inverted index over some documents' tokens, under given term weights."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float, end: int):
        self.terms = []
        owners, terms, weights = [], [], []
        for i, ids in enumerate(docs):
            term, count = np.unique(ids, return_counts=True)
            kept = (idf[term] > 0) & (term != end)
            term, count = term[kept].astype(np.int64), count[kept]
            self.terms.append(term)
            owners.append(np.full(len(term), i, np.int32))
            terms.append(term)
            weights.append(idf[term] * count * (K1 + 1) / (count + K1 * (1 - B + B * len(ids) / mean)))
        self.n = len(docs)
        term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = np.concatenate(owners)[order] if terms else term, np.concatenate(weights)[order] if terms else term
        self.start = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def drop(self, used: np.ndarray) -> None:
        """Forget the postings of used documents."""
        kept = ~used[self.owner]
        before = np.concatenate([[0], np.cumsum(kept)])
        self.owner, self.weight, self.start = self.owner[kept], self.weight[kept], before[self.start]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """BM25 scores of all documents for the query's terms."""
        a, size = self.start[query], self.start[query + 1] - self.start[query]
        total = int(size.sum())
        at = np.repeat(a - np.cumsum(size) + size, size) + np.arange(total)
        return np.bincount(self.owner[at], self.weight[at], minlength=self.n)


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW, end: int = END) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of a shard's documents.

    Whole windows of a long document are sequences of their own; its rest takes part like
    any document.  Ties in score go to the earlier document; when no unused document shares a
    term, the next unused one fills on.
    """
    pieces, sequence = [], 0
    rest = np.zeros(len(docs), np.int64)
    for i, ids in enumerate(docs):
        while len(ids) - rest[i] >= window:
            pieces.append((i, int(rest[i]), window, sequence, 0))
            rest[i] += window
            sequence += 1
    used = np.array([len(ids) == r for ids, r in zip(docs, rest, strict=True)], bool)
    index = Index(docs, idf, mean, end)
    index.drop(used)
    dropped, free, seed, filled = int(used.sum()), 0, -1, 0
    while seed >= 0 or free < len(docs):
        if seed < 0:
            while free < len(docs) and used[free]:
                free += 1
            if free == len(docs):
                break
            seed = free
        used[seed] = True
        if used.sum() - dropped > (len(docs) - dropped) // 2:
            index.drop(used)
            dropped = int(used.sum())
        score = index.scores(index.terms[seed])
        score[used] = -1
        near = np.flatnonzero(score > 0)
        queue = iter([seed, *near[np.argsort(-score[near], kind="stable")].tolist()])
        seed, filled = -1, 0
        while filled < window:
            doc = next(queue, None)
            if doc is None:
                while free < len(docs) and used[free]:
                    free += 1
                if free == len(docs):
                    break
                doc = free
            used[doc] = True
            length = min(window - filled, len(docs[doc]) - int(rest[doc]))
            pieces.append((doc, int(rest[doc]), length, sequence, filled))
            rest[doc] += length
            filled += length
            if rest[doc] < len(docs[doc]):
                seed = doc
        sequence += 1
    return pieces


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end: int = END, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """``doc_id, start, length, ids, doc_tokens, sequence_id, offset``: one row per piece, ``ids`` as little-endian 32-bit numbers.

    Every token of every document lies in one piece; pieces of a sequence follow each other
    from offset 0 without a gap.  Null and empty texts are documents of the end mark alone.
    Repeated rows and null ids are packed like other rows; an empty table gives an empty
    result; other columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    # By rows alone a batch grows with the length of the texts, and its worker with it.
    with set_for(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        tokenized(docs, tokenizer or default_tokenizer(), end).write.option("compression", "zstd").parquet(path)
    table = spark.read.schema("doc_id bigint, ids binary, n bigint, found array<bigint>").parquet(path)
    counts = table.where("found is not null").select(F.posexplode("found").alias("term", "docs")).groupBy("term").agg(F.sum("docs").alias("docs"))
    found = {r.term: r.docs for r in counts.where("docs > 0").collect()}  # one row per token of the vocabulary at most
    rows = table.where("n is not null")
    n_docs, n_tokens = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    idf = np.zeros(1 << 16)
    for term, df in found.items():
        idf[term] = max(0.0, math.log((n_docs - df + 0.5) / (df + 0.5)))
    mean, shards = max(1.0, n_tokens / max(1, n_docs)), max(1, math.ceil(n_tokens / shard_tokens))

    @lean
    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("ids", "ascending")])
        shard = table.column("shard")[0].as_py()
        docs = [np.frombuffer(x.as_py(), "<u2") for x in table.column("ids")]
        pieces = pack_shard(docs, idf, mean, window, end)
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces, strict=True))
        ids = [docs[d][a : a + n].astype("<u4").tobytes() for d, a, n in zip(doc, start, length, strict=True)]
        whole = np.array([len(x) for x in docs], np.int64)[doc]
        return pa.table({"doc_id": table.column("doc_id").take(pa.array(doc)), "start": start, "length": length, "ids": pa.array(ids, pa.binary()), "doc_tokens": whole, "sequence_id": (shard << SHARD_BITS) + sequence, "offset": offset})

    dealt = rows.select(F.pmod(F.xxhash64("doc_id", F.crc32("ids")), F.lit(shards)).cast("int").alias("shard"), "doc_id", "ids")
    out = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
    return dealt.groupBy("shard").applyInArrow(packed, out)
