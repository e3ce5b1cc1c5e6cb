"""Memory of Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa


def release() -> None:
    """Freed memory back to the machine: Arrow's pool and, where the C library can, the heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(function: Callable) -> Callable:
    """A function of one group, or of two grouped together, whose worker keeps nothing of it once it is done."""

    def one(table: pa.Table) -> pa.Table:
        try:
            return function(table)
        finally:
            release()

    def two(table: pa.Table, other: pa.Table) -> pa.Table:
        try:
            return function(table, other)
        finally:
            release()

    return functools.wraps(function)(one if function.__code__.co_argcount == 1 else two)
