"""Give a Python worker's unused memory back when a task ends: Spark keeps workers for later stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")


def release() -> None:
    """Return freed memory of Python, Arrow and the C library to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def released(items: Iterator[T]) -> Iterator[T]:
    """The items of a task's output, with ``release`` after the last."""
    try:
        yield from items
    finally:
        release()
