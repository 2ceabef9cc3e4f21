"""Periodic runs of words, found by internal pattern matching.

A run of period q and at least four periods holds a dyadic block of m words,
m/2 < q <= m, that is followed by a copy of itself after exactly q words: the
block is no shorter than the period, so its occurrences in the window behind it
form one progression, whose difference is the period.  Blocks begin at every
m/2-th word.  Suffixes are sorted by prefix doubling, which gives each block its
interval of the suffix array; a wavelet tree over the array answers, for all
blocks at once, where in the interval the next larger position is.  Candidates
are extended both ways by comparing the classes of the doubling, longest first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from dimforge.llm.shared import pick
from dimforge.llm.shingles import text_chunks

LEAST_WORDS = 6
LEAST_PERIODS = 4
SMALLEST_BLOCK = 4         # words; serves the periods 1 to 4


class SuffixClasses:
    """The suffix array of a sequence, and for every power of two which words begin alike so far.

    ``classes[k][i] == classes[k][j]`` if and only if 2**k words from i and from j on
    are the same; the class is the first place of its interval in the suffix array.
    The sequence must end with a value that it holds only once.
    """

    def __init__(self, sequence: np.ndarray):
        n = len(sequence)
        order = np.argsort(sequence, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order] = self._firsts(sequence[order])
        self.classes, self.sizes = [rank.astype(np.int32)], []
        step = 1
        places = np.arange(n)
        while True:
            self.sizes.append(np.bincount(rank, minlength=n).astype(np.int32))
            places = places[self.sizes[-1][rank[order[places]]] > 1]  # of the array, where more than one suffix is left
            if not len(places):
                break
            at = order[places]
            key = rank[at] * n + rank[np.minimum(at + step, n - 1)]
            new = np.argsort(key, kind="stable")
            order[places] = at[new]  # intervals stay where they are
            key = key[new]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            rank[at[new]] = places[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            self.classes.append(rank.astype(np.int32))
            step *= 2
        self.order = order

    @staticmethod
    def _firsts(values: np.ndarray) -> np.ndarray:
        first = np.ones(len(values), bool)
        first[1:] = values[1:] != values[:-1]
        return np.maximum.accumulate(np.where(first, np.arange(len(values)), 0))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from a and from b on are the same (b within the sequence, a < b)."""
        out = np.zeros(len(a), np.int64)
        last = len(self.classes[0]) - 1
        for k in range(len(self.classes) - 1, -1, -1):
            same = self.classes[k][np.minimum(a + out, last)] == self.classes[k][np.minimum(b + out, last)]
            out[same & (b + out <= last)] += 1 << k
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before a and before b are the same (a < b)."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.classes) - 1, -1, -1):
            i, j = a - out - (1 << k), b - out - (1 << k)
            inside = i >= 0
            same = self.classes[k][np.maximum(i, 0)] == self.classes[k][np.maximum(j, 0)]
            out[inside & same] += 1 << k
        return out


class WaveletTree:
    """Values below 2**bits in their order, a level per bit: zeros go left, ones right, each in their order."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []  # zeros before each place
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - one, dtype=np.int32)]).astype(np.int32))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``least`` at the places low to high - 1; -1 if there is none."""
        rank = self._smaller(low, high, least)
        some = rank < high - low
        out = np.full(len(low), -1, np.int64)
        out[some] = self._nth(low[some], high[some], rank[some])
        return out

    def _smaller(self, low, high, bound):
        """How many values are below the bound."""
        out = np.zeros(len(low), np.int64)
        low, high = low.astype(np.int64), high.astype(np.int64)
        beyond = bound >> self.bits > 0
        for level, zeros in enumerate(self.zeros):
            one = (bound >> (self.bits - 1 - level)) & 1 == 1
            left, right = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            out += np.where(one, right - left, 0)
            low, high = np.where(one, zeros[-1] + low - left, left), np.where(one, zeros[-1] + high - right, right)
        return np.where(beyond, np.iinfo(np.int64).max, out)

    def _nth(self, low, high, n):
        """The n-th smallest value, from 0."""
        out = np.zeros(len(low), np.int64)
        low, high, n = low.astype(np.int64), high.astype(np.int64), n.copy()
        for zeros in self.zeros:
            left, right = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = n >= right - left
            n -= np.where(one, right - left, 0)
            out = 2 * out + one
            low, high = np.where(one, zeros[-1] + low - left, left), np.where(one, zeros[-1] + high - right, right)
        return out


def runs_of(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period.

    ``words`` are the word numbers of all texts in a line, ``bounds`` the texts' ends
    in it.  A run has at least LEAST_WORDS words and LEAST_PERIODS periods, and is
    as long as its smallest period lets it be.
    """
    n = np.diff(bounds)
    text = np.repeat(np.arange(len(n)), n)
    if not len(text):
        return np.zeros((0, 4), np.int64)
    # a word of another text is another symbol, and one that comes only once ends every text
    kinds = int(words.max()) + 2
    line = np.empty(len(words) + len(n), np.int64)
    at = np.arange(len(words)) + text
    line[at] = text * kinds + words
    line[bounds[1:] + np.arange(len(n))] = np.arange(len(n)) * kinds + kinds - 1
    begin = bounds[:-1] + np.arange(len(n))  # of each text in the line
    suffixes = SuffixClasses(line)
    blocks, low, high, longest = [], [], [], []
    for k in range(SMALLEST_BLOCK.bit_length() - 1, len(suffixes.sizes)):
        m = 1 << k
        some = np.flatnonzero(n >= m + m // 2)  # a block and its copy
        count = (n[some] - m) // (m // 2) + 1
        out = np.cumsum(count) - count
        start = (np.arange(count.sum()) - np.repeat(out, count)) * (m // 2) + np.repeat(begin[some], count)
        interval = suffixes.classes[k][start]
        size = suffixes.sizes[k][interval]
        again = size > 1
        blocks.append(start[again])
        low.append(interval[again])
        high.append((interval + size)[again])
        longest.append(np.full(int(again.sum()), m))
    block, low, high, m = (np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
                           for x in (blocks, low, high, longest))
    if not len(block):
        return np.zeros((0, 4), np.int64)
    period = WaveletTree(suffixes.order).successor(low, high, block + 1) - block
    # smaller periods than half a block are those of smaller blocks
    fits = (period > np.where(m == SMALLEST_BLOCK, 0, m // 2)) & (period <= m)
    block, period = block[fits], period[fits]
    before = suffixes.common_before(block, block + period)
    length = before + period + suffixes.common(block, block + period)
    long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
    start = (block - before)[long]
    of = np.searchsorted(begin, start, side="right") - 1
    found = np.stack([of, start - begin[of], period[long], length[long]], axis=1)
    return np.unique(found, axis=0)[:, [0, 1, 3, 2]]


def kept_words(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which words are left when of every run only its first period stays."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    start = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(change, start + runs[:, 3], 1)
    np.add.at(change, start + runs[:, 2], -1)
    return np.cumsum(change)[:-1] == 0


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a line, and the texts' bounds in it."""
    parts = pc.ascii_split_whitespace(pc.fill_null(column, "").cast(pa.large_string()))
    offsets = parts.offsets.to_numpy()
    flat = parts.values
    word = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(word.to_numpy(zero_copy_only=False))])
    return flat.filter(word), before[offsets] - before[offsets[0]]


RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _find():
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            for a, b in text_chunks(batch.column(1)):
                words, bounds = words_of(batch.column(1).slice(a, b - a))
                numbers = words.dictionary_encode().indices.to_numpy() if len(words) else np.zeros(0, np.int64)
                runs = runs_of(numbers.astype(np.int64), bounds)
                kept = kept_words(runs, bounds)
                left = np.concatenate([[0], np.cumsum(kept)])[bounds]
                lines = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(kept)))
                ends = np.searchsorted(runs[:, 0], np.arange(b - a + 1)).astype(np.int32)
                values = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(np.diff(bounds)),
                     pa.ListArray.from_arrays(pa.array(ends), values).cast(kind),
                     pc.binary_join(lines, pa.scalar(" ", pa.large_string())).cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
    return run


def find_runs(documents: DataFrame) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, n_words, runs, collapsed)``.

    ``runs`` are all stretches of words with a smallest period q that are at least
    max(6, 4 q) words long and can't be extended, as (start, length, period) by
    start, then period; ``collapsed`` are the words that no run holds behind its
    first q words, joined by one space.  Null and empty texts and those without
    words have no runs and an empty rest.  Null and repeated doc_ids are kept as
    they are (rows are judged one by one); an empty table gives no rows; other
    columns are ignored.  A task holds the tables of about a megabyte of text, or
    of its longest text.
    """
    return pick(documents, doc_id="long", text="string").mapInArrow(
        _find(), f"doc_id long, n_words long, runs {RUNS}, collapsed string")
