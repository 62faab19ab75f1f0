"""Whole-batch text work on Arrow buffers with numpy.

A batch of texts is one byte array plus row offsets, exactly as Arrow holds
it. Words, n-gram hashes and window minima are computed for all rows of a
slice at once; slices are bounded in bytes, so memory does not depend on the
batch size Spark chooses.

Hashes are polynomials modulo 2**64 followed by a bijective mix. They depend
on content only, so equal pieces of text hash equally in every task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # bytes of text worked on at once
WORD_SEPARATORS = b"\x20\x09\x0a\x0b\x0c\x0d"

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[list(WORD_SEPARATORS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        steps = np.full(size, _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
        steps[1:] = _BASE_INVERSE
        _inverses = np.cumprod(steps, dtype=np.uint64)
    return _powers, _inverses


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finalizer over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = column.cast(pa.large_binary())
    if binary.null_count:
        binary = pc.fill_null(binary, b"")
    n = len(binary)
    buffers = binary.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64, count=n + 1, offset=8 * binary.offset) if n else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    first, last = int(offsets[0]), int(offsets[-1])
    return data[first:last], offsets - first


def row_slices(offsets: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``budget`` bytes; a longer text comes alone."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + budget, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends and the index of each row's first word.

    The third array has one entry per row and one more, so words of row r are
    ``[first[r], first[r + 1])``. Words never cross rows.
    """
    n = len(data)
    if n == 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SEPARATOR[data]
    edge = np.zeros(n + 1, dtype=bool)  # a row begins here
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range; ranges are ascending and disjoint."""
    out = np.empty(len(starts), dtype=np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(int(np.searchsorted(ends, starts[i] + SLICE_BYTES, side="right")), i + 1)
        low, high = int(starts[i]), int(ends[j - 1])
        power, inverse = _tables(high - low + 1)
        prefix = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=prefix[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix64((prefix[e] - prefix[s]) * inverse[s])
        i = j
    return out


def gram_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive values (len - width + 1)."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    power, inverse = _tables(n + 1)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * power[:n], out=prefix[1:])
    return mix64((prefix[width:] - prefix[:-width]) * inverse[: n - width + 1])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values (len - width + 1)."""
    done, out = 1, values
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def runs_covered(hits: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Union of ``[h, h + width)`` over ascending starts ``hits``, as intervals."""
    if len(hits) == 0:
        return hits, hits
    breaks = np.flatnonzero(np.diff(hits) > width)
    first = np.concatenate(([0], breaks + 1))
    last = np.concatenate((breaks, [len(hits) - 1]))
    return hits[first], hits[last] + width


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals in any order; touching intervals become one."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.concatenate(([True], s[1:] > e[:-1]))
    first = np.flatnonzero(fresh)
    return s[first], e[np.concatenate((first[1:] - 1, [len(e) - 1]))]
