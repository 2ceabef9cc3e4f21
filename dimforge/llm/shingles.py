"""Words and 5-word shingles of whole text columns as numpy arrays.

A word is a run of bytes other than space and 0x09-0x0D, A-Z lower-cased.  The
bytes of an Arrow string column are processed together; words never cross rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit sums so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_values(fold: bool = True) -> np.ndarray:
    """A factor for every byte; ``fold`` gives A-Z those of a-z."""
    lower = np.arange(256, dtype=np.uint64)
    if fold:
        lower[ord("A"):ord("Z") + 1] += np.uint64(32)
    return _mix((lower + np.uint64(1)) * _BASE) | np.uint64(1)


def text_chunks(column: pa.Array, most_bytes: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most_bytes`` of text each (one row at least)."""
    size = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, before + most_bytes, side="right")))
        yield start, end
        start = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the row boundaries in them; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[bounds[0]:bounds[-1]], bounds - bounds[0]


def word_starts(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes are in a word, and which begin one."""
    inside = ~((flat == 32) | ((flat >= 9) & (flat <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    rows = bounds[:-1][bounds[:-1] < len(flat)]
    first[rows] = inside[rows]
    return inside, first


def hash_runs(flat: np.ndarray, inside: np.ndarray, first: np.ndarray, values: np.ndarray):
    """Hash, begin and length of the byte runs that ``first`` begins among the bytes ``inside``."""
    at = np.flatnonzero(inside)
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts, starts
    begin = np.searchsorted(at, starts)  # a word's first byte among the non-space bytes
    lengths = np.diff(np.append(begin, len(at)))
    place = np.arange(len(at)) - np.repeat(begin, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE | np.uint64(1), dtype=np.uint64))
    return _mix(np.add.reduceat(values[flat[at]] * powers[place], begin)), starts, lengths


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the first word index of every row (one more entry than rows)."""
    flat, bounds = text_bytes(column)
    if not len(flat):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    hashes, starts, _ = hash_runs(flat, *word_starts(flat, bounds), byte_values())
    return hashes, np.searchsorted(starts, bounds)


def shingle_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 5-word windows of each row (with repeats) and their row boundaries.

    A row of one to four words has one shingle, the whole sequence.
    """
    words, bounds = word_hashes(column)
    n = np.diff(bounds)
    odd = np.multiply.accumulate(np.full(WIDTH, np.uint64(0xD6E8FEB86659FD93), dtype=np.uint64))
    weighted = np.zeros(len(words), np.uint64)
    padded = np.concatenate([words, np.zeros(WIDTH, np.uint64)])
    for k in range(WIDTH):
        weighted += padded[k:k + len(words)] * odd[k]
    counts = np.where(n >= WIDTH, n - WIDTH + 1, (n > 0).astype(n.dtype))
    out = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    at = np.repeat(bounds[:-1] - out[:-1], counts) + np.arange(out[-1])
    hashes = weighted[at] if len(at) else np.zeros(0, np.uint64)
    for row in np.flatnonzero((n > 0) & (n < WIDTH)):
        w = words[bounds[row]:bounds[row + 1]]
        hashes[out[row]] = (w * odd[:len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))
    return _mix(hashes), out


def distinct_sets(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort and make distinct the values of every row (in place); the values left and their boundaries."""
    if not len(hashes):
        return hashes, bounds
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        hashes[a:b].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = hashes[1:] != hashes[:-1]
    keep[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return hashes[keep], kept[bounds]
