"""Memory of the Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Memory that is free but still held by this process goes back to the system."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``task`` over batches; what it used and no longer holds is given back when it ends, not kept beside later tasks."""

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run
