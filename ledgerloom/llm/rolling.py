"""Hashes over Arrow text columns with numpy: words, shingles and fixed-length byte strings.

A polynomial over the bytes, modulo 2**64, with running sums: any span's hash is one
difference and one product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` of each at least."""
    if len(_tables[0]) < n:
        n = max(n, 1 << 20)
        for i, b in enumerate((BASE, INVERSE)):
            row = np.full(n, b, np.uint64)
            row[0] = 1
            _tables[i] = np.cumprod(row, dtype=np.uint64)
    return _tables[0], _tables[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of ``x`` over all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        data = b"".join(x.as_py() or b"" for x in column)
        return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(lengths)])
    if column.buffers()[2] is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = 1 << 20):
    """Runs of texts of about ``most`` bytes; a longer text is a run of its own."""
    a = 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        yield a, b
        a = b


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums of the polynomial, one longer than ``data``."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of words before it."""
    n = len(data)
    space = np.ones(n + 1, bool)
    space[1:] = IS_SPACE[data]
    inner = ~space[1:]
    begins = inner & space[:-1]
    edge = offsets[:-1][offsets[:-1] < n]
    begins[edge] = inner[edge]
    ends = np.zeros(n, bool)
    ends[:-1] = inner[:-1] & (space[2:] | begins[1:])
    if n:
        ends[-1] = inner[-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = sums(data)
    _, down = powers(len(data) + 1)
    return mixed((total[ends] - total[starts]) * down[starts])


def shingles(column: pa.Array, n: int):
    """For each run of texts: first text, and each text's sorted distinct hashes of ``n`` words.

    A text of fewer words is one shingle, one without words has none.
    """
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        part, at = LOWER[data[offsets[a] : offsets[b]]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = word_spans(part, at)
        word = word_hashes(part, starts, ends)
        m = max(0, len(word) - n + 1)
        runs = np.zeros(m, np.uint64)
        for j in range(n):
            runs += word[j : j + m] * np.uint64((2 * j + 3) * 0xD6E8FEB86659FD93 % (1 << 64) | 1)
        runs = mixed(runs)
        sets = []
        for i in range(b - a):
            s, e = int(first[i]), int(first[i + 1])
            if e - s >= n:
                sets.append(np.unique(runs[s : e - n + 1]))
            elif e > s:
                whole = np.zeros(1, np.uint64)
                for j in range(e - s):
                    whole += word[s + j : s + j + 1] * np.uint64((2 * j + 3) * 0xD6E8FEB86659FD93 % (1 << 64) | 1)
                sets.append(mixed(whole + np.uint64(e - s)))
            else:
                sets.append(np.zeros(0, np.uint64))
        yield a, sets
