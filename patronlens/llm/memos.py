"""One remembering operator at a time in a Python worker.

Workers live on from task to task and serve several operators. What one of them remembers is of no use to the next, so it
is forgotten when another one takes over, and the memory goes back to the system: a worker is as large as one operator.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_HOLDER: list[tuple[str, Callable[[], None]]] = []


def take_over(name: str, forget: Callable[[], None]) -> None:
    """``name`` remembers from now on; ``forget`` is called once another one does."""
    if _HOLDER and _HOLDER[0][0] == name:
        return
    if _HOLDER:
        _HOLDER.pop()[1]()
        give_back()
    _HOLDER.append((name, forget))


def give_back() -> None:
    """Return freed memory to the system, where its C library can, and that of Arrow's batches."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
