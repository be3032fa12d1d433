"""Vectorised word segmentation and hashing over Arrow text batches (numpy, inside Spark tasks).

A batch's texts are one UTF-8 buffer with offsets; words are found and hashed for all rows at once. Words never
cross a row boundary. Hashes are 64-bit polynomial sums over random byte codes, finished with an avalanche step; the
byte codes and multipliers are fixed, so every task and every run agrees.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = (1 << 20) - 1    # texts are worked on in row groups of about this many bytes (one row at least)

_rng = np.random.Generator(np.random.PCG64(20240229))
_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
LETTER = np.zeros(256, bool)
LETTER[list(range(0x30, 0x3A)) + list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100))] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Give freed memory back to the system: a worker lives through many tasks, and what one has freed would else
    stay with it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                             # another C library: nothing to give back by hand
        pass


def tidy(group: Callable) -> Callable:
    """A function of one or two whole groups that releases its memory when it is done."""
    def run(*tables):
        try:
            return group(*tables)
        finally:
            release()

    # Spark tells grouped functions from cogrouped ones by the number of their arguments
    return (lambda left, right: run(left, right)) if group.__code__.co_argcount == 2 else (lambda table: run(table))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, base in enumerate((_BASE, _BASE_INV)):
            t = np.full(size, base, np.uint64)
            t[0] = 1
            _powers[i] = np.multiply.accumulate(t)
    return _powers[0], _powers[1]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit avalanche (a bijection), salted."""
    h = h + np.uint64((0x632BE59BD9B4E019 * (2 * salt + 1)) & (2**64 - 1))
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; nulls become empty rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, off, data = column.buffers()
    if off is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(off, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    buf = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]]
    return buf, offsets - offsets[0]


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` bytes (a longer row is a range of its own)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


class Words:
    """The words of some rows: byte spans, the row of each word and the first word of each row."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE):
        self.buf, self.offsets = buf, offsets
        n = len(buf)
        member = np.zeros(n + 2, bool)
        member[1:-1] = inside[buf]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        m = member[1:]
        before = member[:-1]
        self.starts = np.flatnonzero(m & (~before | cut))
        self.ends = np.flatnonzero(before & (~m | cut))
        self.first = np.searchsorted(self.starts, offsets)            # rows + 1 entries
        self.counts = np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def prefix(self) -> np.ndarray:
        up, _ = _power_tables(len(self.buf) + 1)
        p = np.empty(len(self.buf) + 1, np.uint64)
        p[0] = 0
        codes = _CODES[self.buf]
        codes *= up[:len(self.buf)]
        np.cumsum(codes, out=p[1:])
        return p

    def hashes(self, prefix: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hash of each word (or of the part of it up to ``ends``)."""
        p = self.prefix() if prefix is None else prefix
        e = self.ends if ends is None else ends
        down = _power_tables(len(self.buf) + 1)[1]
        return mix((p[e] - p[self.starts]) * down[self.starts])


def chunks(column: pa.Array, inside: np.ndarray = NOT_SPACE, table: np.ndarray | None = None,
           limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) for consecutive row ranges of a text column; ``table`` maps bytes first."""
    buf, offsets = text_buffer(column)
    for lo, hi in row_chunks(offsets, limit):
        part = buf[offsets[lo]:offsets[hi]]
        yield lo, hi, Words(table[part] if table is not None else part, offsets[lo:hi + 1] - offsets[lo], inside)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` consecutive word hashes that start at each position (the last ``n - 1`` positions mix in
    the words of following rows and must be masked by the caller)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = h[:len(h) - n + 1].copy()
    for i in range(1, n):
        out *= np.uint64(_BASE)
        out += h[i:len(h) - n + 1 + i]
    return mix(out, n)
