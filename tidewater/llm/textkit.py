"""Vectorised text work shared by the operators, on Arrow string batches.

A word is a run of bytes other than space, tab, LF, VT, FF and CR; A-Z are
lower-cased.  These bytes never occur inside a multi-byte UTF-8 character, so
all work is done on the UTF-8 bytes with numpy, a bounded slice at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5          # fixed by the contract of the shingle operators
SLICE_BYTES = 1 << 20      # text handled at once; one longer text is one slice

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche (splitmix64), on uint64 arrays."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base modulo 2**64."""
    global _powers
    if len(_powers) < n:
        step = np.full(max(n, 64), _BASE, np.uint64)
        step[0] = 1
        _powers = np.multiply.accumulate(step)
    return _powers[:n]


def text_slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of successive slices;
    a null is an empty text.  A slice holds at most ``max_bytes`` or one text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    arr = column.cast(pa.large_binary()).fill_null(b"")
    n = len(arr)
    if n == 0:
        return
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, first byte and byte after the last of each word, first
    word of each text and the total) of a slice."""
    bounds = np.zeros(len(offs), np.int64)
    if not len(data):
        e = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), e, e, bounds
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts_at = offs[:-1][offs[:-1] < len(data)]
    first[starts_at] |= inside[starts_at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends_at = offs[1:][offs[1:] > 0] - 1
    last[ends_at] |= inside[ends_at]
    begin = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    bounds = np.searchsorted(begin, offs).astype(np.int64)
    if not len(begin):
        return np.zeros(0, np.uint64), begin, end, bounds
    lens = end - begin
    at = np.cumsum(lens) - lens
    body = _LOWER[data[inside]]
    within = np.arange(len(body)) - np.repeat(at, lens)
    val = _BYTE[body] * powers(int(lens.max()))[within]
    h = np.add.reduceat(val, at) + lens.astype(np.uint64)
    return mix64(h), begin, end, bounds


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k-gram that starts at each word (the last k-1 are junk)."""
    n = len(h)
    out = np.full(n, k, np.uint64)
    mul = np.uint64(_BASE)
    for j in range(k):
        out *= mul
        if j < n:
            out[:n - j] += h[j:]
    return mix64(out)


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """Sorted distinct k-word shingle hashes of each text of a slice.  A text
    with fewer words has its whole sequence as one shingle; one without words
    has the empty set."""
    h, _, _, bounds = words(data, offs)
    grams = ngrams(h, k)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= k:
            out.append(np.unique(grams[lo:hi - k + 1]))
        elif hi > lo:
            out.append(ngrams(h[lo:hi], hi - lo)[:1])
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def rows_of(batch: pa.RecordBatch, column: str = "text", max_bytes: int = SLICE_BYTES
            ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``text_slices`` of one column of a record batch."""
    return text_slices(batch.column(batch.schema.get_field_index(column)), max_bytes)


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """Record batch of the given columns (arrays, numpy arrays or lists)."""
    arrays = [c if isinstance(c, pa.Array) and c.type == f.type
              else (c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type))
              for f, c in zip(schema, columns)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def concat_ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the ranges [start, start + len), one after another."""
    lens = np.asarray(lens, np.int64)
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = np.cumsum(lens) - lens
    return np.arange(total) - np.repeat(at, lens) + np.repeat(np.asarray(starts, np.int64), lens)


def bytes_of(arr: pa.LargeBinaryArray) -> list[bytes]:
    """The values of an array without nulls, several times as fast as ``to_pylist``."""
    if not len(arr):
        return []
    offs = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    lo = int(offs[0])
    raw = arr.buffers()[2].slice(lo, int(offs[-1]) - lo).to_pybytes() if offs[-1] > lo else b""
    ends = (offs - lo).tolist()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]
