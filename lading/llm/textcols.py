"""Vectorised text primitives over Arrow string columns.

A text column is handled as one byte buffer plus offsets, so splitting into
words, hashing words and hashing word windows are a few numpy passes per
slice instead of Python loops over words.  Slices are bounded in bytes
(``SLICE_BYTES``; a longer single text is a slice of its own), which bounds
the temporaries of a task whatever the batch size.

Word rule (all operators that speak of words): maximal runs of bytes other
than space and the control characters 9-13; ASCII letters are lower-cased
for hashing.  Hashes are 64 bit: equality of hashes stands for equality of
words or windows, with a collision probability of about n^2 / 2^65 for n
different values.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18          # temporaries (8 bytes a byte) stay in cache

_U = np.uint64
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)
_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the hash base and of its inverse modulo 2^64."""
    global _pow, _inv
    while len(_pow) < n:
        k = len(_pow)
        _pow = np.concatenate([_pow, _pow * _U(pow(_P, k, 1 << 64))])
        _inv = np.concatenate([_inv, _inv * _U(pow(_P_INV, k, 1 << 64))])
    return _pow[:n], _inv[:n]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Avalanche of 64-bit values (splitmix64 finalizer)."""
    x = x + _U((0x9E3779B97F4A7C15 * (2 * salt + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def utf8_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, int64 offsets) of a string column; null texts are empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return buf, off - off[0]


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a text column into runs of rows of at most ``max_bytes`` (at least
    one row): (first row, end row, bytes, offsets within the run)."""
    buf, off = utf8_buffers(column)
    lo, n = 0, len(column)
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, buf[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def release() -> None:
    """Give the freed memory of Arrow batches and numpy temporaries back at the
    end of a task: the worker goes on to other tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc alone has it
    if trim:
        trim(0)


def packed(values: np.ndarray) -> bytes:
    """Numbers as zstd over their byte planes: small ones take little room."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T) if len(values) else values
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, dtype) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.zeros(0, dtype)
    raw = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, n).T).view(dtype).ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys by their differences."""
    return packed(np.diff(keys, prepend=_U(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, np.uint64), dtype=np.uint64)


def is_space(buf: np.ndarray) -> np.ndarray:
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def lowered(buf: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return np.frombuffer(buf.tobytes().translate(_LOWER), dtype=np.uint8)


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the row each belongs to."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z
    space = is_space(buf)
    first = np.zeros(n + 1, dtype=bool)
    first[off[:-1]] = True                      # also marks offsets of empty rows; harmless
    before = np.empty(n, dtype=bool)
    before[0] = True
    before[1:] = space[:-1]
    before |= first[:n]
    starts = np.flatnonzero(~space & before)
    after = np.empty(n, dtype=bool)
    after[-1] = True
    after[:-1] = space[1:]
    first[off[-1]] = True
    after |= first[1:]
    ends = np.flatnonzero(~space & after) + 1
    rows = np.searchsorted(off[1:], starts, side="right")
    return starts, ends, rows


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every byte span [start, end)."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _powers(len(buf))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    values = (lowered(buf) if lower else buf).astype(np.uint64)
    values += _U(1)
    values *= power
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes (row
    boundaries ignored; callers keep the windows inside one row)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += mix(words[k:k + n], k + 1) * _U(2 * k + 3)
    return mix(total)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.empty(len(values), dtype=bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def distinct_counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    at = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
    return values[at], np.diff(np.append(at, len(values)))


def row_cuts(rows: np.ndarray, n: int) -> np.ndarray:
    """First word of every row and the end of the last: word k of row i are
    words[cuts[i]:cuts[i + 1]]."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingle_sets(words: np.ndarray, cuts: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per row, the sorted distinct hashes of its ``size``-word shingles; with
    fewer words the whole sequence is one shingle; without words, none."""
    windows = window_hashes(words, size)
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hi - lo >= size:
            yield distinct(windows[lo:hi - size + 1])
        elif hi > lo:
            yield window_hashes(words[lo:hi], hi - lo) ^ _U(hi - lo)
        else:
            yield words[:0]
