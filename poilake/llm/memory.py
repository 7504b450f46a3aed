"""What a task's Python worker keeps when the task has ended."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def give_back() -> None:
    """Return freed memory to the system: Spark keeps workers, and what they hold, for later tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
