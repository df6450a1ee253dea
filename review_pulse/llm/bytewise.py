"""UTF-8 texts of an Arrow column as numpy arrays: word spans, word hashes, bounded groups.

Everything works on the bytes of many texts at once, so no Python code runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n+1 places where they start; NULL counts as an empty text."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def groups(starts: np.ndarray, limit: int = 4 * BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together; a longer text is a range of its own."""
    low, count = 0, len(starts) - 1
    while low < count:
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + limit, "right")) - 1)
        yield low, high
        low = high


def spans(data: np.ndarray, starts: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, ...]:
    """Begin and end of every run of bytes that ``inside`` marks, and each text's first run.

    A run never reaches from one text into the next.
    """
    mask = inside[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = mask[:-1], mask[1:]
    edges = starts[1:-1]
    before[edges[edges < len(data)]] = False
    after[edges[edges > 0] - 1] = False
    begin, end = np.flatnonzero(mask & ~before), np.flatnonzero(mask & ~after) + 1
    return begin, end, np.searchsorted(begin, starts)


def mixed(values: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the 64-bit input."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, block by block through prefix sums."""
    base = int(_MULTIPLIER)
    inverse = pow(base, -1, 1 << 64)
    out = np.empty(len(begin), np.uint64)
    room = 1 + max(BLOCK, int((end - begin).max())) if len(begin) else 0
    up, down = _powers(base, room), _powers(inverse, room)
    low = 0
    while low < len(begin):
        high = max(low + 1, int(np.searchsorted(end, begin[low] + BLOCK, "right")))
        first, last = int(begin[low]), int(end[high - 1])
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(up[: last - first] * (data[first:last].astype(np.uint64) + np.uint64(1)), out=sums[1:])
        left, right = begin[low:high] - first, end[low:high] - first
        out[low:high] = (sums[right] - sums[left]) * down[left]
        low = high
    return mixed(out + (end - begin).astype(np.uint64) * _MULTIPLIER)
