"""What Python workers hold beyond a batch.

A worker serves one task after another, also of other stages and operators. So what it holds longer than a task, such as an
automaton or a vocabulary, has one slot: the next thing takes the place of the last. When a task ends, or is cut short, freed memory
goes back to the machine instead of to the worker's allocators.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable, Iterator
from typing import TypeVar

import pyarrow as pa

T = TypeVar("T")
_HELD: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """What this process holds under ``key``, made if it holds something else."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], holds: bool = False, after: Callable[[], None] | None = None):
    """A function on batches that gives memory back at its end. One that ``holds`` nothing drops what others left."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds and _HELD:
            _HELD.clear()
            _give_back()
        try:
            yield from run(batches)
        finally:
            if after:
                after()
            _give_back()

    return tidied
