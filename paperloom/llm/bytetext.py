"""Words of many texts at once: numpy over the bytes of an Arrow column.

Separators and letters A-Z are ASCII, so words can be cut and folded on the
UTF-8 bytes without decoding. Null texts count as empty.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 20
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
KEEP = np.arange(256, dtype=np.uint8)
#: Bytes that end a word: blank and the control characters 9 to 13.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def release() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: what it does by itself has to do


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` with a release at the end of each task, since a worker outlives its task and the next one may be another's."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        step = np.full(max(n, 1 << 16), _STEP)
        step[0] = 1
        _powers = np.multiply.accumulate(step)
    return _powers


def pieces(column: pa.Array, limit: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` bytes: first row, end row, bytes, offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


@dataclass
class Words:
    """Runs of non-separator bytes; ``first[d]:first[d + 1]`` are those of text ``d``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray


def words(data: np.ndarray, offsets: np.ndarray, fold: np.ndarray = FOLD, separators: np.ndarray = BLANK) -> Words:
    data = fold[data]
    inside = ~separators[data]
    size = len(data)
    edge = offsets[(offsets < size)]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[edge] = inside[edge]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    before = edge[edge > 0] - 1
    finishes[before] = inside[before]
    start, end = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    first = np.searchsorted(start, offsets)
    if not len(start):
        return Words(data, start, end, first, np.zeros(0, np.uint64))
    place = np.arange(size)
    place -= np.maximum.accumulate(np.where(begins, place, 0))
    place *= inside
    value = _BYTE[data] * powers(int(place.max()) + 1)[place]
    value *= inside
    return Words(data, start, end, first, mix(np.add.reduceat(value, start)))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` successive word hashes, text borders ignored."""
    size = max(0, len(hashes) - n + 1)
    out = np.zeros(size, np.uint64)
    for j, p in enumerate(powers(n)[:n]):
        out += hashes[j : j + size] * p
    return mix(out)


def sequence(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole short sequence, apart from every window hash."""
    total = (hashes * powers(len(hashes))[: len(hashes)]).sum(dtype=np.uint64, keepdims=True)
    return mix(total + np.uint64(len(hashes) * 0xD1B54A32D192ED03 % 2**64))[0]


def shingle_set(w: Words, grams: np.ndarray, d: int, n: int) -> np.ndarray:
    """Sorted distinct ``n``-word shingles of text ``d``; all its words as one if fewer."""
    a, b = int(w.first[d]), int(w.first[d + 1])
    if b - a >= n:
        return np.unique(grams[a : b - n + 1])
    return np.array([sequence(w.hash[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64)
