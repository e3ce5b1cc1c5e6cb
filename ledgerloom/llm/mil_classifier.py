"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words.  Every passage is encoded from its
bytes and words alone; gated attention, learned from document labels, weighs the passages,
and the weighted mean is scored.  The model is fitted on a bounded sample of labelled
documents; scoring streams over all texts, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import rolling

PASSAGE = 64
HASHED = 64
SURFACE = 12
HIDDEN, GATE = 24, 12
#: Labelled documents a model is fitted on, at most.
FIT_DOCS = 6_000
#: Passages of one document that are learned from.
FIT_PASSAGES = 1_024
EPOCHS, BATCH, RATE, DECAY = 14, 128, 0.01, 1e-4
SEED = 1
# The byte classes counted in a passage.
BYTE_CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#*$%&|<>", b"!?", b"0123456789", b".,;:", b"\n", b"@/\\_=+~^{}[]")


def _masks() -> np.ndarray:
    out = np.zeros((len(BYTE_CLASSES), 256), np.int32)
    for i, chars in enumerate(BYTE_CLASSES):
        out[i, list(chars)] = 1
    return out


MASKS = _masks()


def passages(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each run of texts: first text, passage features, and each text's first passage (and the end)."""
    data, offsets = rolling.text_bytes(column)
    for a, b in rolling.chunks(offsets):
        part, at = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = rolling.word_spans(part, at)
        counts = np.diff(first)
        bags = np.maximum(1, -(-counts // PASSAGE))
        bag = np.concatenate([[0], np.cumsum(bags)])
        owner = np.repeat(np.arange(b - a), counts)
        passage = bag[owner] + (np.arange(len(starts)) - first[owner]) // PASSAGE
        n = int(bag[-1])
        x = np.zeros((n, SURFACE + HASHED), np.float32)
        words = np.bincount(passage, minlength=n).astype(np.float64)
        per = np.maximum(words, 1)
        size = np.maximum(np.bincount(passage, ends - starts, minlength=n), 1)
        begin = np.zeros(n, np.int64)
        begin[passage[::-1]] = starts[::-1]
        stop = np.zeros(n, np.int64)
        stop[passage] = ends
        for i, mask in enumerate(MASKS):
            total = np.concatenate([[0], np.cumsum(mask[part], dtype=np.int64)])
            x[:, i] = (total[stop] - total[begin]) / size
        wide = np.concatenate([[0], np.cumsum((part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[:-1] == 0xC3), dtype=np.int64)]) if len(part) else np.zeros(1, np.int64)
        x[:, 0] += (wide[np.maximum(stop - 1, 0)] - wide[np.maximum(begin - 1, 0)]) / size
        word = rolling.word_hashes(rolling.LOWER[part], starts, ends)
        k = len(BYTE_CLASSES)
        x[:, k] = size / per / 10
        same = np.concatenate([[False], (word[1:] == word[:-1]) & (passage[1:] == passage[:-1])]) if len(word) else np.zeros(0, bool)
        x[:, k + 1] = np.bincount(passage, same, minlength=n) / per
        key = np.unique(passage.astype(np.uint64) << np.uint64(40) | word >> np.uint64(24))
        x[:, k + 2] = np.bincount((key >> np.uint64(40)).astype(np.int64), minlength=n) / per
        x[:, k + 3] = words / PASSAGE
        x[:, k + 4] = np.bincount(passage, ends - starts > 12, minlength=n) / per
        hashed = np.bincount(passage * HASHED + (word % np.uint64(HASHED)).astype(np.int64), minlength=n * HASHED)
        x[:, SURFACE:] = hashed.reshape(n, HASHED) / per[:, None]
        yield a, x, bag


@dataclass
class Model:
    """Weights of the encoder, the gated attention and the output, and the features' scales."""

    weights: dict[str, np.ndarray]
    mean: np.ndarray
    scale: np.ndarray

    def attend(self, x: np.ndarray, bag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of bags and attention of passages."""
        return _forward(self.weights, (x - self.mean) / self.scale, bag)[:2]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict[str, np.ndarray], x: np.ndarray, bag: np.ndarray):
    first, size = bag[:-1], np.diff(bag)
    h = np.tanh(x @ w["encode"] + w["encode_0"])
    t, g = np.tanh(h @ w["attend"]), _sigmoid(h @ w["gate"])
    e = (t * g) @ w["weigh"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), size))
    a = e / np.repeat(np.add.reduceat(e, first), size)
    z = np.add.reduceat(a[:, None] * h, first)
    return _sigmoid(z @ w["out"] + w["out_0"]), a, h, t, g, z


def _gradients(w, x, bag, y):
    score, a, h, t, g, z = _forward(w, x, bag)
    size = np.diff(bag)
    d = (score - y) / len(y)
    dz = np.repeat(d[:, None] * w["out"], size, axis=0)
    da = (dz * h).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, bag[:-1]), size))
    dt, dg = de[:, None] * w["weigh"] * g * (1 - t * t), de[:, None] * w["weigh"] * t * g * (1 - g)
    dh = (a[:, None] * dz + dt @ w["attend"].T + dg @ w["gate"].T) * (1 - h * h)
    return {"encode": x.T @ dh, "encode_0": dh.sum(axis=0), "attend": h.T @ dt, "gate": h.T @ dg, "weigh": (t * g).T @ de, "out": z.T @ d, "out_0": d.sum()}


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """A model of bags ``bag`` over passages ``x`` with labels ``y``; Adam on small batches."""
    rng = np.random.default_rng(seed)
    n = x.shape[1]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 0.02
    x = (x - mean) / scale
    init = lambda a, b: rng.normal(0, 1 / np.sqrt(a), (a, b))
    w = {"encode": init(n, HIDDEN), "encode_0": np.zeros(HIDDEN), "attend": init(HIDDEN, GATE), "gate": init(HIDDEN, GATE), "weigh": init(GATE, 1)[:, 0], "out": init(HIDDEN, 1)[:, 0], "out_0": np.zeros(())}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(u) for k, u in w.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            some = order[at : at + BATCH]
            size = np.diff(bag)[some]
            cut = np.concatenate([[0], np.cumsum(size)])
            rows = np.repeat(bag[some] - cut[:-1], size) + np.arange(cut[-1])
            step += 1
            rate = RATE * (0.1 ** (epoch / epochs)) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for k, grad in _gradients(w, x[rows], cut, y[some]).items():
                grad = grad + DECAY * w[k]
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                w[k] = w[k] - rate * m[k] / (np.sqrt(v[k]) + 1e-8)
    return Model({k: np.asarray(u, np.float32) for k, u in w.items()}, mean.astype(np.float32), scale.astype(np.float32))


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept out of learning."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "utf-8")) % 5 == 0


def _spaced(i: int, j: int) -> np.ndarray:
    """Places from ``i`` to before ``j``, at most ``FIT_PASSAGES`` of them, evenly spaced."""
    return np.arange(i, j) if j - i <= FIT_PASSAGES else np.linspace(i, j - 1, FIT_PASSAGES).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, fit_docs: int = FIT_DOCS) -> Model:
    """A model of ``quality`` learned from at most ``fit_docs`` labelled documents that are not held out.

    The sample is drawn by a hash of the id; of a text with more than ``FIT_PASSAGES`` passages so many, evenly spaced, teach, so that what
    reaches the driver is bounded.  Null labels and ids teach nothing.  Without any
    label every score is one half; with labels of one kind, scores go that way.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).select("doc_id", F.col("quality").cast("double").alias("quality"))
    picked = known.groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quality = batch.column("quality")
            for a, x, bag in passages(batch.column("text")):
                rows = [x[_spaced(i, j)].astype("<f4").tobytes() for i, j in zip(bag[:-1], bag[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([quality.slice(a, len(rows)), pa.array(rows, pa.binary())], ["quality", "bag"])

    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").orderBy("doc_id").select("quality", "text")
    rows = sample.mapInArrow(encode, "quality double, bag binary").collect()
    width = SURFACE + HASHED
    if not rows:
        zero = {"encode": (width, HIDDEN), "encode_0": (HIDDEN,), "attend": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "weigh": (GATE,), "out": (HIDDEN,), "out_0": ()}
        return Model({k: np.zeros(s, np.float32) for k, s in zero.items()}, np.zeros(width, np.float32), np.ones(width, np.float32))
    bags = [np.frombuffer(r.bag, "<f4").reshape(-1, width) for r in rows]
    bag = np.concatenate([[0], np.cumsum([len(b) for b in bags])])
    return train(np.concatenate(bags), bag, np.array([min(1.0, max(0.0, r.quality)) for r in rows]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1) and ``passage``, the passage with most attention, per document.

    Null and empty texts are one empty passage.  Repeated rows score alike; an empty table gives
    an empty result; only ``doc_id`` and ``text`` are read.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, x, bag in passages(batch.column("text")):
                scores, attention = model.attend(x, bag)
                most = np.array([int(np.argmax(attention[i:j])) for i, j in zip(bag[:-1], bag[1:], strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, len(most)), pa.array(scores.astype(np.float64)), pa.array(most)], ["doc_id", "score", "passage"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scored, f"doc_id {kind}, score double, passage bigint")
