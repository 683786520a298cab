"""Text columns as blocks of bytes, and their words as arrays of 64-bit hashes.

Helpers for functions that run on Arrow batches. A block holds a bounded number of bytes, or a single longer text, so that
memory doesn't depend on how many rows a batch has. Words are hashed all at once from prefix sums over the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of a block, and of a piece that is hashed at once.
BLOCK_BYTES = 1 << 20
PIECE_BYTES = 1 << 19

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
#: Bytes with A-Z made lower case; all others unchanged.
LOWER = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint8)
#: White space of the words that contracts write as ``[^\x20\x09-\x0D]+``.
SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
#: Whatever is neither an ASCII letter or digit nor beyond ASCII: ``[\x00-\x2F\x3A-\x60\x7B-\x7F]`` in lower case.
MARK = ~(((_BYTE >= 48) & (_BYTE <= 57)) | _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values, by sorting."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


@dataclass(frozen=True)
class Block:
    """Rows ``first`` to ``first + len(offsets) - 2`` of a batch: their bytes end to end, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(texts: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a text column into blocks of at most ``most`` bytes, or one longer text. Null reads as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, at, raw = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        high = min(high, len(texts))
        yield Block(low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_BASE, _BASE_INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


@cache
def _piece_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(PIECE_BYTES + 1)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte range; ranges are in order and don't overlap. Prefix sums hash all ranges of a piece at once."""
    hashes = np.empty(len(starts), np.uint64)
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + PIECE_BYTES, "right")))
        first, last = starts[low], ends[high - 1]
        n = int(last - first)
        up, down = _piece_powers() if n <= PIECE_BYTES else _powers(n + 1)  # those of a longer word aren't kept
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        at = starts[low:high] - first
        hashes[low:high] = (sums[ends[low:high] - first] - sums[at]) * down[at]
        low = high
    return mix(hashes)


@dataclass(frozen=True)
class Words:
    """Words of a block: hash, byte range, and row within the block."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray

    def bounds(self, rows: int) -> np.ndarray:
        """Where each row's words begin; one more than rows."""
        return np.searchsorted(self.row, np.arange(rows + 1))


def places(block: Block, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the longest runs of bytes that are no ``breaks``, row by row."""
    data, n = block.data, len(block.data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~breaks[data]
    head = np.zeros(n + 1, bool)  # where a row begins
    head[block.offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | head[1:n]
    ends = inside
    ends[:-1] &= ~inside[1:] | head[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(block.offsets, starts, "right") - 1


def words(block: Block, breaks: np.ndarray) -> Words:
    """The words of each row: longest runs of bytes that are no ``breaks``, with A-Z in lower case."""
    starts, ends, row = places(block, breaks)
    return Words(run_hashes(LOWER[block.data], starts, ends), starts, ends, row)
