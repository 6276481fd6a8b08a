"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_held: tuple[str, Callable[[], None]] | None = None


def hold(kind: str, drop: Callable[[], None]) -> None:
    """Say what the worker keeps from now on; what tasks of another kind kept is dropped first.

    Workers outlive stages. Tables that speed up one stage would otherwise stay while the next fills its own.
    """
    global _held
    if _held and _held[0] == kind:
        return
    if _held:
        _held[1]()
        gc.collect()
        pa.default_memory_pool().release_unused()
        # The C library keeps freed memory until it is told to give it back.
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    _held = (kind, drop)
