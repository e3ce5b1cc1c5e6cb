"""Removal of long byte strings that occurred earlier in the corpus, by deep-shallow suffix sorting.

A removed byte is covered by a string of ``LENGTH`` bytes that starts earlier too.  Every
such string has an anchor: the place of the smallest hash among its ``GRAM``-byte strings.
Equal strings have equal anchors at equal places, so only anchors found twice or more can
carry repeats, and only the text around those leaves its block, once per block.

A bucket sorts what stands right of its anchors, and what stands left of them backwards.
Shallow: multikey quicksort, eight bytes at a time, down to ``SHALLOW`` bytes.  Deep:
strings still equal are put in order by a blind trie, which also tells their common
lengths.  Two strings with the anchor at offset ``d`` are equal if their left sides share
``d`` bytes and their right sides the rest: both are runs of the sorted orders.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import blocks, rolling
from ledgerloom.llm.memory import lean

LENGTH = 100
GRAM = 16
SHALLOW = 24
PIECE = 1 << 20
LAST = np.iinfo(np.int64).max


def runs_of_anchors(data: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of string starts with one anchor: first start, last start, anchor, hash of the anchor's bytes.

    ``data`` is one text of at most ``PIECE`` bytes.  On ties the leftmost place counts.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    total = rolling.sums(data)
    _, down = rolling.powers(len(data) + 1)
    hashes = rolling.mixed((total[gram:] - total[:-gram]) * down[: len(data) - gram + 1])
    least = hashes & ~np.uint64(PIECE - 1) | np.arange(len(hashes), dtype=np.uint64)
    width, size = length - gram + 1, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < width:
        least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
    anchor = (least[:n] & np.uint64(PIECE - 1)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    last = np.r_[first[1:], n] - 1
    return first, last, anchor[first], hashes[anchor[first]]


class Block:
    """A block's documents in corpus order: by id (null last), then text."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.block = table.column("block")[0].as_py()
        self.ids = table.column("doc_id").to_pylist()
        self.data, self.offsets = rolling.text_bytes(table.column("text"))

    def runs(self):
        """For all documents: document, first start, last start, anchor and hash, places within the document."""
        out = []
        for i in range(len(self.ids)):
            a, b = int(self.offsets[i]), int(self.offsets[i + 1])
            for at in range(a, max(a + 1, b - LENGTH + 1), PIECE - LENGTH + 1):
                first, last, anchor, mark = runs_of_anchors(self.data[at : min(b, at + PIECE)])
                shift = at - a
                out.append((np.full(len(first), i), first + shift, last + shift, anchor + shift, mark))
        return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)]


# --- deep-shallow sorting -----------------------------------------------------


class BlindTrie:
    """A trie whose inner nodes know only where their strings first differ.

    Going down compares nothing but the bytes at those places; one look at a leaf's string
    then tells where a new string belongs.  A node is ``[place, {byte: child}]``, a leaf the
    list of equal strings' numbers; a string's end counts as byte -1.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def add(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        new = self.strings[i]
        node, path = self.root, []
        while isinstance(node, tuple):
            path.append(node)
            at = node[0]
            node = node[1].get(new[at] if at < len(new) else -1) or next(iter(node[1].values()))
        old = self.strings[node[0]]
        place = common(new, old)
        if place == len(new) == len(old):
            node.append(i)
            return
        depth = 0
        while depth < len(path) and path[depth][0] < place:
            depth += 1
        byte = new[place] if place < len(new) else -1
        if depth < len(path) and path[depth][0] == place:
            path[depth][1][byte] = [i]
            return
        below = path[depth] if depth < len(path) else node
        made = (place, {(old[place] if place < len(old) else -1): below, byte: [i]})
        if depth:
            above = path[depth - 1]
            above[1][new[above[0]] if above[0] < len(new) else -1] = made
        else:
            self.root = made

    def order(self) -> tuple[list[int], list[int]]:
        """String numbers in order, and what each shares with the one before it (the first: 0)."""
        numbers: list[int] = []
        shared: list[int] = []
        todo = [(self.root, 0)]
        while todo:
            node, lcp = todo.pop()
            if isinstance(node, tuple):
                children = [node[1][b] for b in sorted(node[1])]
                todo.extend((c, node[0]) for c in reversed(children[1:]))
                todo.append((children[0], lcp))
            else:
                numbers += node
                shared += [lcp, *[len(self.strings[node[0]])] * (len(node) - 1)]
        return numbers, shared


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    diff = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (diff.bit_length() + 7) // 8


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings, and the common prefix of each with the one before it in that order.

    Common prefixes between strings that differ within ``shallow`` bytes are exact too.
    """
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array([len(s) for s in strings])
    padded = np.frombuffer(b"".join(s[:shallow].ljust(shallow, b"\0") for s in strings), ">u8").reshape(n, shallow // 8)
    order, group = np.arange(n), np.zeros(n, np.int64)
    for word in range(shallow // 8):  # one key of the multikey quicksort after another, within groups still equal
        key = padded[order, word].astype(np.uint64)
        by = np.lexsort((size[order].clip(max=shallow) if word == shallow // 8 - 1 else key, key, group))
        order, group, key = order[by], group[by], key[by]
        group = np.cumsum(np.r_[False, (np.diff(group) != 0) | (key[1:] != key[:-1])])
    head = size[order].clip(max=shallow)
    group = np.cumsum(np.r_[False, (np.diff(group) != 0) | (np.diff(head) != 0)])
    shared = np.zeros(n, np.int64)
    edges = np.r_[np.flatnonzero(np.r_[True, np.diff(group) != 0]), n]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a > 1:
            trie = BlindTrie(strings)
            for i in order[a:b].tolist():
                trie.add(i)
            numbers, lcps = trie.order()
            order[a:b], shared[a:b] = numbers, lcps
        if a:
            shared[a] = common(strings[order[a - 1]], strings[order[a]])
    return order, shared


def repeated_offsets(low: np.ndarray, high: np.ndarray, right: list[bytes], left: list[bytes], length: int = LENGTH) -> np.ndarray:
    """For segments in corpus order: which offsets of the anchor belong to a string seen in an earlier segment.

    A segment holds the strings with the anchor at offsets ``low`` to ``high``; ``right`` starts
    at the anchor, ``left`` runs back from it.
    """
    n = len(low)
    by_right, right_lcp = deep_shallow_sort(right)
    by_left, left_lcp = deep_shallow_sort(left)
    out = np.zeros((n, length), bool)
    if not n:
        return out
    right_class, left_class = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int(low.min()), int(high.max()) + 1):
        inside = np.flatnonzero((low <= d) & (d <= high))
        if len(inside) > 1:
            right_class[by_right] = np.cumsum(right_lcp < length - d)
            left_class[by_left] = np.cumsum(left_lcp < d)
            key = right_class[inside] * (n + 1) + left_class[inside]
            _, first = np.unique(key, return_index=True)
            again = np.ones(len(inside), bool)
            again[first] = False
            out[inside[again], d] = True
    return out


# --- Spark stages ---------------------------------------------------------------

SEGMENTS = "bucket int, block int, doc int, doc_id bigint, anchor bigint, low int, high int, mark bigint, bytes binary"
SPANS = "block int, doc int, start bigint, stop bigint"


def _segments(texts: DataFrame, answers: DataFrame, count: int) -> DataFrame:
    """Text around shared anchors, once per block; repeats inside a block come as finished spans (``bytes`` null, ``low`` to ``high`` the span)."""

    @lean
    def cut(table: pa.Table, replies: pa.Table) -> pa.Table:
        own = Block(table)
        doc, first, last, anchor, mark = own.runs()
        keep = blocks.times_of(mark, count, blocks.known(replies)) >= 2
        doc, first, last, anchor, mark = doc[keep], first[keep], last[keep], anchor[keep], mark[keep]
        bucket = blocks.cut_by_bucket(mark, count)[0]
        data, base = own.data.tobytes(), own.offsets[doc]
        seen: set[tuple[int, bytes]] = set()
        fresh = np.zeros(len(doc), bool)
        pieces = []
        for i, (a, b, d) in enumerate(zip((base + first).tolist(), (base + last + LENGTH).tolist(), (anchor - first).tolist(), strict=True)):
            piece = (d, data[a:b])
            if piece not in seen:
                seen.add(piece)
                fresh[i] = True
                pieces.append(piece[1])
        old = ~fresh
        at = np.flatnonzero(fresh)
        pieces = pa.concat_arrays([pa.array(pieces, pa.binary()), pa.nulls(int(old.sum()), pa.binary())])
        at = np.concatenate([at, np.flatnonzero(old)])
        known = fresh[at]
        ids = np.array([LAST if x is None else x for x in own.ids], np.int64)
        return pa.table(
            {
                "bucket": pa.array(bucket[at].astype(np.int32)),
                "block": pa.array(np.full(len(at), own.block, np.int32)),
                "doc": pa.array(doc[at].astype(np.int32)),
                "doc_id": pa.array(ids[doc[at]] if len(ids) else np.zeros(0, np.int64)),
                "anchor": pa.array(np.where(known, anchor[at], first[at])),
                "low": pa.array(np.where(known, anchor[at] - last[at], 0).astype(np.int32)),
                "high": pa.array(np.where(known, anchor[at] - first[at], last[at] - first[at] + LENGTH).astype(np.int32)),
                "mark": pa.array(mark[at].view(np.int64)),
                "bytes": pieces,
            }
        )

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(cut, SEGMENTS)


@lean
def _sorted_bucket(table: pa.Table) -> pa.Table:
    """Spans of a bucket's strings that have an earlier equal."""
    column = lambda c: table.column(c).to_numpy()
    order = np.lexsort((column("anchor"), column("doc"), column("block"), column("doc_id")))
    block, doc, anchor = column("block")[order], column("doc")[order], column("anchor")[order]
    low, high = column("low")[order].astype(np.int64), column("high")[order].astype(np.int64)
    data = [x.as_py() for x in table.column("bytes").take(pa.array(order))]
    right = [x[h:] for x, h in zip(data, high.tolist(), strict=True)]
    left = [x[:h][::-1] for x, h in zip(data, high.tolist(), strict=True)]
    again = repeated_offsets(low, high, right, left)
    edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    start, stop = anchor[row] - (end - 1), anchor[row] - begin + LENGTH
    return pa.table({"block": pa.array(block[row].astype(np.int32)), "doc": pa.array(doc[row].astype(np.int32)), "start": pa.array(start), "stop": pa.array(stop)})


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: byte spans to remove (start, stop) and the bytes that stay.

    Null texts are empty; texts of fewer than ``LENGTH`` bytes lose nothing.  Earlier means a
    smaller id (null last; rows that repeat an id: by text), or an earlier start in the same
    document.  Matches never cross documents.  An empty table gives an empty result, other
    columns are not read.
    """
    count = blocks.block_count(docs)
    texts = blocks.blocked(docs, count)
    answers = blocks.shared_features(texts, count, lambda table: Block(table).runs()[4])
    segments = _segments(texts, answers, count)
    found = segments.where("bytes is not null").groupBy("bucket").applyInArrow(_sorted_bucket, SPANS)
    inside = segments.where("bytes is null").selectExpr("block", "doc", "anchor as start", "anchor + high as stop")
    spans = found.unionByName(inside)

    @lean
    def removed(table: pa.Table, spans: pa.Table) -> pa.Table:
        own = Block(table)
        doc = spans.column("doc").to_numpy()
        order = np.argsort(doc, kind="stable")
        doc, start, stop = doc[order], spans.column("start").to_numpy()[order], spans.column("stop").to_numpy()[order]
        cut = np.searchsorted(doc, np.arange(len(own.ids) + 1))
        rows = []
        for i in range(len(own.ids)):
            a, b = int(own.offsets[i]), int(own.offsets[i + 1])
            depth = np.zeros(b - a + 1, np.int32)
            np.add.at(depth, start[cut[i] : cut[i + 1]], 1)
            np.add.at(depth, stop[cut[i] : cut[i + 1]], -1)
            gone = np.cumsum(depth[:-1]) > 0
            edge = np.diff(np.r_[False, gone, False].astype(np.int8))
            pairs = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)
            rows.append((own.ids[i], b - a, pairs.tolist(), own.data[a:b][~gone].tobytes()))
        kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "spans": pa.list_(pa.list_(pa.int64())), "kept": pa.binary()}
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(kinds.items())})

    return texts.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(removed, "doc_id bigint, n_bytes bigint, spans array<array<bigint>>, kept binary")
