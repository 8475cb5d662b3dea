"""What a Python worker keeps between its tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_KEPT: dict = {}


def give_back() -> None:
    """Returns memory that is free but still held by this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # an allocator that has no such call
        pass


def kept(key, make: Callable):
    """The worker's ``key``, made where there is none. Only the last one asked for is kept.

    Spark uses its workers again, for other stages too, so the memo of one operator would otherwise
    stay in memory beside that of the next; what it took goes back to the system.
    """
    if key not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[key] = make()
    return _KEPT[key]
