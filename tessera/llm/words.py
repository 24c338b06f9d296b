"""Words and shingles of byte texts as 64-bit numbers, a batch of documents at a time."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
#: Bytes hashed at once (about).
BLOCK = 1 << 19

_HELD: dict = {}


def held(name: str, make: Callable):
    """What this Python worker remembers for one operator, over all its tasks. Another operator's memory goes first, so
    a worker that serves many holds one at a time."""
    if name not in _HELD:
        _HELD.clear()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Give freed memory back where the C library and Arrow can: an idle worker counts in full beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def let_go() -> None:
    """Forget what this worker remembers, and give the memory back."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        give_back()


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(33))


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: int, rows: int = 1024, size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Parts of ``batches`` of at most so many rows, and so many bytes of the column ``text`` unless a row alone has more."""
    let_go()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        past = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = past[at] - lengths[at]
            end = min(at + rows, max(at + 1, int(np.searchsorted(past, before + size, side="right"))))
            yield batch.slice(at, end - at)
            at = end
    give_back()


#: What separates words: blanks and the control characters 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z as a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _table() -> np.ndarray:
    """A number of 64 bits for each byte in each of 64 places of a word; none for what separates words."""
    values = mix(mix(np.arange(1, 256 * 64 + 1, dtype=np.uint64) * _MULTIPLIER) ^ _MIX[0]).reshape(256, 64)
    values[SPACE] = 0
    return values[LOWER].ravel()


class Words(NamedTuple):
    """The words of some texts one after the other: hashes, first bytes, and the line and text that each is in.

    Lines are numbered over all texts in rising order, with gaps.
    """

    data: np.ndarray
    numbers: np.ndarray
    starts: np.ndarray
    line: np.ndarray
    text: np.ndarray
    offsets: np.ndarray


TABLE = _table()


def word_hashes(data: np.ndarray, starts: np.ndarray, stop: int, table: np.ndarray = TABLE, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of the word from each of ``starts`` on, and its number of kept bytes; ``stop`` is where the last one's
    text ends. Without ``kept``, a flag for each byte, all count, and the numbers have no meaning.

    A word's hash sums a number for each kept byte in its place (simple tabulation), and so words of any length are
    hashed without a loop over them.
    """
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out, size = np.empty(len(starts), np.uint64), np.zeros(len(starts), np.int64)
    past = np.append(starts[1:], stop)
    at = 0
    while at < len(starts):
        end = max(at + 1, int(np.searchsorted(past, starts[at] + BLOCK, side="right")))
        first, last = int(starts[at]), int(past[end - 1])
        here, sizes = starts[at:end] - first, past[at:end] - starts[at:end]
        part = data[first:last]
        if kept is None:
            place = np.arange(last - first) - np.repeat(here, sizes)
        else:
            flag = kept[part]
            before = np.cumsum(flag) - flag
            place = before - np.repeat(before[here], sizes)
            size[at:end] = np.add.reduceat(flag, here, dtype=np.int64)
        value = table[(part.astype(np.int64) << 6) | (place & 63)]
        if place.max() > 63:
            value = value * ((place >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        out[at:end] = np.add.reduceat(value, here)
        at = end
    return mix(out), size


def spans_of(column: pa.Array) -> Words:
    """The words of a column of texts, without their hashes; null has none."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    seen = ~SPACE[data]
    new = seen.copy()
    new[1:] &= ~seen[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    new[edges] = seen[edges]
    starts = np.flatnonzero(new)
    text = np.searchsorted(offsets, starts, side="right") - 1
    line = np.searchsorted(np.flatnonzero(data == 10), starts) + text
    return Words(data, np.zeros(0, np.uint64), starts, line, text, offsets)


def words_of(column: pa.Array) -> Words:
    """The words of a column of texts; null has none."""
    words = spans_of(column)
    return words._replace(numbers=word_hashes(words.data, words.starts, len(words.data))[0])


def shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; of the whole sequence, if it is shorter; nothing of nothing."""
    n = len(numbers)
    if not n:
        return numbers
    take = min(n, width)
    out = np.full(n - take + 1, take, np.uint64)
    for i in range(take):
        out = out * _MULTIPLIER + numbers[i : n - take + 1 + i]
    return mix(out)
