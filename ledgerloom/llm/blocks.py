"""Which features of a block of documents occur elsewhere too.

Documents are dealt to blocks once.  Every block sends its distinct feature hashes, each
once with a count, to buckets; a bucket adds the counts up and tells each block which of
its features occur at least twice in all.  Only those need to travel further.  A feature of
a third of all documents costs one entry per block, so no bucket is hot.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.memory import lean

LEAST_BLOCK = 4 << 20
MOST_BLOCK = 512 << 20
#: Bytes of text behind one message from a block to a bucket, on average.
MESSAGE = 64 << 10
LOW = np.uint64(0xFFFFFFFF)


def block_count(docs: DataFrame, text: str = "text") -> int:
    """Blocks grow with the square root of the text, so that messages neither shrink nor multiply without end."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(total / min(MOST_BLOCK, max(LEAST_BLOCK, math.isqrt(total * MESSAGE)))))


def blocked(docs: DataFrame, count: int) -> DataFrame:
    """``block, doc_id, text`` dealt by a hash of the id; null texts are empty."""
    block = F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int")
    return docs.select(block.alias("block"), "doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition(count, "block")


def cut_by_bucket(hashes: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the hashes, and the 32 bits that stand for a hash inside its bucket."""
    return ((hashes >> np.uint64(32)) % np.uint64(count)).astype(np.int64), (hashes & LOW).astype(np.uint32)


def joint_keys(hashes: np.ndarray, count: int) -> np.ndarray:
    bucket, short = cut_by_bucket(hashes, count)
    return bucket.astype(np.uint64) << np.uint64(32) | short


def shared_features(texts: DataFrame, count: int, features: Callable[[pa.Table], np.ndarray]) -> DataFrame:
    """``block, bucket, short, times``: features counted twice or more over all blocks.

    ``features`` gives the 64-bit hashes of a block, repeats included.  ``short`` holds the
    ascending 32-bit stand-ins and ``times`` the counts, both as bytes.  Two features that
    share bucket and stand-in count as one; that may only add features to the answer.
    """

    @lean
    def sent(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        keys, times = np.unique(joint_keys(features(table), count), return_counts=True)
        bucket = (keys >> np.uint64(32)).astype(np.int64)
        cut = np.searchsorted(bucket, np.arange(count + 1))
        full = [k for k in range(count) if cut[k] < cut[k + 1]]
        short, times = (keys & LOW).astype("<u4"), np.minimum(times, 0xFFFFFFFF).astype("<u4")
        piece = lambda x: pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in full], pa.binary())
        return pa.table({"bucket": pa.array(full, pa.int32()), "block": pa.array([block] * len(full), pa.int32()), "short": piece(short), "times": piece(times)})

    @lean
    def answered(table: pa.Table) -> pa.Table:
        shorts = [np.frombuffer(x.as_py(), "<u4") for x in table.column("short")]
        times = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("times")]).astype(np.uint64)
        keys, at = np.unique(np.concatenate(shorts), return_inverse=True)
        total = np.zeros(len(keys), np.uint64)
        np.add.at(total, at, times)
        total = np.minimum(total, LOW).astype("<u4")[at]
        ends = np.cumsum([len(x) for x in shorts])
        rows = []
        for block, short, end in zip(table.column("block").to_pylist(), shorts, ends, strict=True):
            own = total[end - len(short) : end]
            if (own >= 2).any():
                rows.append((block, short[own >= 2].tobytes(), own[own >= 2].tobytes()))
        bucket = table.column("bucket")[0].as_py()
        names = {"block": pa.int32(), "short": pa.binary(), "times": pa.binary()}
        made = {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(names.items())}
        return pa.table({"block": made["block"], "bucket": pa.array([bucket] * len(rows), pa.int32()), "short": made["short"], "times": made["times"]})

    messages = texts.groupBy("block").applyInArrow(sent, "bucket int, block int, short binary, times binary")
    return messages.groupBy("bucket").applyInArrow(answered, "block int, bucket int, short binary, times binary")


def known(answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ascending joint keys of a block's shared features, and their counts."""
    if not answers.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    order = np.argsort(answers.column("bucket").to_numpy())
    shorts, times = answers.column("short").to_pylist(), answers.column("times").to_pylist()
    bucket = answers.column("bucket").to_pylist()
    keys = [np.frombuffer(shorts[i], "<u4").astype(np.uint64) | np.uint64(bucket[i] << 32) for i in order]
    return np.concatenate(keys), np.concatenate([np.frombuffer(times[i], "<u4") for i in order])


def times_of(hashes: np.ndarray, count: int, answers: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How often each feature occurs in all, 1 for those no one else has."""
    keys, times = answers
    out = np.ones(len(hashes), np.int64)
    if len(keys) and len(hashes):
        own = joint_keys(hashes, count)
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        hit = keys[at] == own
        out[hit] = times[at[hit]]
    return out
