"""Array helpers for Arrow batches of text: word spans and 64-bit hashes over the raw UTF-8 bytes.

All separators used by the operators are ASCII, so words can be cut on bytes. A batch is worked
in slices of about ``SLICE_BYTES`` of text; a longer single document is one slice of its own, so
memory follows the longest document, not the batch.
"""

from __future__ import annotations

import ctypes
import gc

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

#: words ``[^\x20\x09-\x0D]+``
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

#: byte -> byte with A-Z lower-cased
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every bit of a 64-bit value over the whole value."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_BYTE_LOWER = _BYTE[LOWER]


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First ``n`` powers of the base and of its inverse; one pair of tables is kept, for the largest ``n`` so far."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        _POWERS.clear()
        for base in (_BASE, _BASE_INV):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS[0], _POWERS[1]


def release() -> None:
    """Give back what a task's arrays leave in a Python worker, which Spark keeps for later tasks and stages."""
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: its allocator decides
        pass


def released(run):
    """``run`` over a task's batches, then :func:`release`."""
    def task(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return task


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES, rows: int = 20_000):
    """Cut a batch (no copy) into runs of at most ``rows`` rows whose texts sum to about ``limit`` bytes."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total, start = np.cumsum(lengths), 0
    while start < batch.num_rows:
        base = total[start - 1] if start else 0
        stop = min(start + rows, max(start + 1, int(np.searchsorted(total, base + limit, "right"))))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and the ``n + 1`` offsets; a null text is empty."""
    col = pc.fill_null(col, "").cast(pa.large_string())
    if not len(col):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def runs(keep: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of kept bytes inside each document: starts, ends, document numbers."""
    n = len(keep)
    if not n:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e
    first, last = keep.copy(), keep.copy()
    edge = offs[1:-1][(offs[1:-1] > 0) & (offs[1:-1] < n)]
    cut = np.zeros(n + 1, dtype=bool)
    cut[edge] = True
    first[1:] &= ~keep[:-1] | cut[1:n]
    last[:-1] &= ~keep[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span (equal spans, wherever they stand, get equal hashes)."""
    n = len(buf)
    if not n or not len(starts):
        return mix(np.zeros(len(starts), dtype=np.uint64))
    power, inverse = _powers(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * power[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive values (over document ends too: mask those)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    acc = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        acc = acc * np.uint64(_BASE) + h[j:j + m]
    return mix(acc)


def whole_windows(doc: np.ndarray, n: int) -> np.ndarray:
    """Which windows of ``n`` consecutive words lie in one document."""
    m = len(doc) - n + 1
    return doc[:m] == doc[n - 1:] if m > 0 else np.zeros(0, dtype=bool)


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes that ``span_hashes`` gives the same words."""
    col = pa.array(words, type=pa.large_string())
    buf, offs = text_bytes(col)
    return span_hashes(buf, offs[:-1], offs[1:])


class HashTable:
    """Rows by 64-bit hash: open addressing over arrays, looked up and extended for whole columns of hashes."""

    def __init__(self, room: int):
        self.size = 1 << max(10, (2 * room).bit_length())
        self.keys = np.zeros(self.size, dtype=np.uint64)
        self.rows = np.zeros(self.size, dtype=np.int32)
        self.n = 0

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes without 0 (which marks a free place), and where each of them starts to look."""
        h = np.where(h == 0, np.uint64(1), h)
        return h, (h >> np.uint64(20)).astype(np.int64) & (self.size - 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is not there."""
        h, at = self._places(h)
        out = np.full(len(h), -1, dtype=np.int64)
        left = np.arange(len(h))
        while len(left):
            key = self.keys[at[left]]
            hit = key == h[left]
            out[left[hit]] = self.rows[at[left[hit]]]
            left = left[~hit & (key != 0)]
            at[left] = (at[left] + 1) & (self.size - 1)
        return out

    def add(self, h: np.ndarray) -> np.ndarray:
        """Rows for distinct hashes that are not there yet: the next numbers in turn."""
        if 2 * (self.n + len(h)) > self.size:
            old, rows = self.keys[self.keys != 0], self.rows[self.keys != 0]
            self.size = 1 << (2 * (self.n + len(h))).bit_length()
            self.keys, self.rows = np.zeros(self.size, dtype=np.uint64), np.zeros(self.size, dtype=np.int32)
            self._put(old, rows)
        new = np.arange(self.n, self.n + len(h))
        self._put(h, new)
        self.n += len(h)
        return new

    def _put(self, h: np.ndarray, rows: np.ndarray) -> None:
        h, at = self._places(h)
        left = np.arange(len(h))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            self.keys[at[free]] = h[free]  # of several for one place the last stays
            won = free[self.keys[at[free]] == h[free]]
            self.rows[at[won]] = rows[won]
            lost = np.ones(len(h), dtype=bool)
            lost[won] = False
            left = left[lost[left]]
            at[left] = (at[left] + 1) & (self.size - 1)


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Mask over ``n`` items of those inside any window ``[start, start + width)``."""
    d = np.zeros(n + 1, dtype=np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + width, -1)
    return np.cumsum(d[:n]) > 0


def fresh(columns: list[str], name: str) -> str:
    """``name``, with underscores in front until no column has it (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
