"""Words and shingles of whole texts as 64-bit hashes, computed for a batch of texts at once.

A hash of bytes is a polynomial over a table of random numbers, taken from running sums, so the hash of any substring
costs a subtraction. Equal strings always have equal hashes; different ones share one with a chance of about 2**-64.
"""

from __future__ import annotations

import ctypes
from functools import cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
#: Everything in ASCII but letters and digits.
MARKS = bytes(c for c in range(128) if not chr(c).isalnum())
#: Bytes of text that are treated together.
BATCH = 1_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def byte_values(fold: bool) -> np.ndarray:
    """A random number per byte; with ``fold`` A-Z share those of a-z."""
    values = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if fold:
        values[65:91] = values[97:123]
    return values


_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    kept = _powers.get(inverse)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, BATCH), BASE_INVERSE if inverse else BASE, np.uint64)
        steps[0] = 1
        kept = np.cumprod(steps)
        if n <= 4 * BATCH:
            _powers[inverse] = kept
    return kept[:n]


def released(run, *tables):
    """The same function over batches, after which the worker gives its memory back: Spark keeps idle workers alive,
    and beside the next stage's they would count. ``tables`` are caches to clear."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            _powers.clear()
            for t in tables:
                t.cache_clear()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except OSError:
                pass  # another C library

    return wrapped


class Texts:
    """The bytes of a batch of texts, and where each begins and ends."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        if column.null_count:
            column = column.fill_null(b"")
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.bytes = whole[offsets[0] : offsets[-1]]
        self.starts, self.ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]

    def sums(self, fold: bool) -> np.ndarray:
        """Running polynomial sums; entry i covers the first i bytes."""
        out = np.zeros(len(self.bytes) + 1, np.uint64)
        np.multiply(byte_values(fold)[self.bytes], powers(len(self.bytes)), out=out[1:])
        return np.cumsum(out, out=out)

    def words(self, apart: bytes = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text number, start, end) of all words; ``apart`` are the bytes between them."""
        table = np.ones(256, bool)
        table[list(apart)] = False
        inside = table[self.bytes]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begun = self.starts[self.starts < self.ends]
        first[begun] = inside[begun]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        closed = begun[begun > 0] - 1
        last[closed] = inside[closed]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return np.searchsorted(self.starts, starts, "right") - 1, starts, ends


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(len(sums), True)[starts])


def slices(column: pa.Array, most: int = BATCH):
    """(first row, slice) of a column of texts, of about ``most`` bytes each and one text at least."""
    sizes = column.cast(pa.large_binary()).fill_null(b"")
    ends = np.cumsum(np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset + 1 : sizes.offset + len(sizes) + 1] - np.frombuffer(sizes.buffers()[1], np.int64)[sizes.offset : sizes.offset + len(sizes)])
    at = 0
    while at < len(column):
        done = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, done + most, "right")))
        yield at, column.slice(at, end - at)
        at = end


def shingles(texts: Texts, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of every run of ``width`` lower-cased words; a text of fewer words gives one run of all."""
    owner, starts, ends = texts.words()
    if not len(owner):
        return owner, np.empty(0, np.uint64)
    words = substring_hashes(texts.sums(fold=True), starts, ends)
    n = len(words)
    counts = np.bincount(owner, minlength=len(texts.starts))
    total = np.zeros(n, np.uint64)
    for k in range(width):
        weight = mix(np.array([k + 1], np.uint64))[0] | np.uint64(1)
        same = np.zeros(n, bool)
        same[: n - k] = owner[k:] == owner[: n - k]
        total[: n - k] += np.where(same[: n - k], words[k:] * weight, np.uint64(0))
    position = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    size = counts[owner]
    kept = (position <= size - width) | ((size < width) & (position == 0))
    hashes = mix(total[kept] + np.minimum(size[kept], width).astype(np.uint64))
    return owner[kept], hashes
