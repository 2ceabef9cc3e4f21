"""Best-fit-decreasing packing of tokenised documents into sequences.

Placing documents by size needs only how many pieces of each length there are:
at most ``capacity`` counts, whatever the size of the corpus.  The plan is made
from those counts, a length at a time from the longest: a segment tree over the
remaining capacities finds the tightest open sequences, and as many pieces as
fit go there together.  Spark numbers the pieces of each length, and the plan
says where the n-th piece of a length stands.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimforge.llm.shared import batch_of, lean, map_batches, pick, store
from dimforge.llm.shingles import byte_values, hash_runs, text_bytes, text_chunks, word_starts

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 300_000      # words whose ids a task remembers at once
JOINED_WORDS = 64
BATCH_LINES = 32           # encoded at once: their tokens take far more memory than the ids kept of them
CHUNK = 250_000            # bytes of text at once: the arrays take some fifty times as much
RANKED_ROWS = 200_000      # rows of one length numbered in one task, about


# --- tokens --------------------------------------------------------------------------------------

def _signs_at_end(flat: np.ndarray, inside: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Begins of the run of ASCII signs with which a word ends, if there is an ASCII letter before it."""
    lower = flat | 32
    letter = (lower >= 97) & (lower <= 122)
    sign = inside & (flat < 128) & ~letter & ~((flat >= 48) & (flat <= 57))
    starts = sign.copy()
    starts[1:] &= letter[:-1] & ~first[1:]
    starts[:1] = False
    # a run of signs ends a word if what follows it is no part of the word
    at = np.flatnonzero(starts)
    change = np.flatnonzero(np.append(~sign[1:] | first[1:], True))  # last positions of runs
    last = change[np.searchsorted(change, at)]
    ends = np.ones(len(at), bool)
    more = last + 1 < len(flat)
    ends[more] = ~inside[last[more] + 1] | first[last[more] + 1]
    out = np.zeros(len(flat), bool)
    out[at[ends]] = True
    return out


class WordIds:
    """Token ids by word.  The tokenizer never joins characters across white space, so words can be looked up.

    Signs at the end of a word, behind an ASCII letter, are tokens of their own
    too.  Words not known yet are encoded many at a time, with one of the
    tokenizer's special tokens, which never joins with anything, between them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the threads here, and each thread keeps memory of its own
        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.between = max(special, key=special.get, default="")
        self.between_id = special.get(self.between)
        self.special = [x.encode() for x in special]
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.pool = np.full(1, END_ID, np.uint32)

    def _ids_of(self, words: list[bytes], plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids in a line, and where those of each word begin and how many they are."""
        if plain and self.between:
            mark = self.between.encode()
            lines = [mark.join(words[k:k + JOINED_WORDS]).decode() for k in range(0, len(words), JOINED_WORDS)]
            ids = np.concatenate([np.array([*e.ids, self.between_id], np.uint32) for k in range(0, len(lines), BATCH_LINES)
                                  for e in self.tokenizer.encode_batch_fast(lines[k:k + BATCH_LINES], add_special_tokens=False)])
            ends = np.flatnonzero(ids == self.between_id)
            begin = np.append(0, ends[:-1] + 1)
            return ids, begin, ends - begin
        found = [np.array(e.ids, np.uint32) for k in range(0, len(words), BATCH_LINES) for e in
                 self.tokenizer.encode_batch_fast([w.decode() for w in words[k:k + BATCH_LINES]], add_special_tokens=False)]
        size = np.array([len(x) for x in found], np.int64)
        return np.concatenate(found), np.cumsum(size) - size, size

    def _learn(self, hashes: np.ndarray, words: list[bytes], plain: bool) -> None:
        ids, begin, size = self._ids_of(words, plain)
        at = np.searchsorted(self.hashes, hashes)  # both are sorted
        self.begin = np.insert(self.begin, at, begin + len(self.pool))
        self.size = np.insert(self.size, at, size)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.pool = np.concatenate([self.pool, ids])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in a line, END_ID behind each, and the row boundaries in them."""
        flat, bounds = text_bytes(column)
        rows = len(bounds) - 1
        if len(flat):
            inside, first = word_starts(flat, bounds)
            data = flat.tobytes()
            special = any(x in data for x in self.special)  # special tokens have signs in them, and are told by case
            if not special:
                first |= _signs_at_end(flat, inside, first)
            hashes, starts, lengths = hash_runs(flat, inside, first, byte_values(fold=not special))
        else:
            hashes = starts = lengths = np.zeros(0, np.int64)
        if not len(hashes):
            return np.full(rows, END_ID, np.uint32), np.arange(rows + 1)
        known, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHE_WORDS:
            self.clear()
        place = np.searchsorted(self.hashes, known)
        new = np.ones(len(known), bool)
        inside_range = place < len(self.hashes)
        new[inside_range] = self.hashes[place[inside_range]] != known[inside_range]
        if new.any():
            self._learn(known[new], [data[s:s + n] for s, n in
                                     zip(starts[at[new]].tolist(), lengths[at[new]].tolist(), strict=True)], not special)
            place = np.searchsorted(self.hashes, known)
        begin, size = self.begin[place][inverse], self.size[place][inverse]
        # END_ID as one more word behind each row
        row_of = np.searchsorted(starts, bounds[1:])
        begin = np.insert(begin, row_of, 0)  # the pool begins with END_ID
        size = np.insert(size, row_of, 1)
        last_word = row_of + np.arange(rows)
        out = np.cumsum(size)
        ids = self.pool[np.repeat(begin - out + size, size) + np.arange(out[-1])]
        return ids, np.concatenate([[0], out[last_word]])


def _cut(path: str, capacity: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def run(batches):
        words = WordIds(path)
        for batch in batches:
            for a, b in text_chunks(batch.column(1), CHUNK):
                ids, bounds = words.encode(batch.column(1).slice(a, b - a))
                size = np.diff(bounds)
                pieces = -(-size // capacity)
                row = np.repeat(np.arange(b - a), pieces)
                out = np.cumsum(pieces) - pieces
                piece = np.arange(len(row)) - out[row]
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                data = memoryview(ids.astype("<u4").tobytes())
                begin = (bounds[row] + start) * 4
                crc = [zlib.crc32(data[s:s + n * 4]) for s, n in zip(begin.tolist(), length.tolist(), strict=True)]
                yield batch_of(schema, pc.take(batch.column(0).slice(a, b - a), pa.array(row)), piece, start, length, crc)
    return run


def tokenized_pieces(documents: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """``documents(doc_id, text)`` -> ``(doc_id, piece, start, length, ids_crc32)``.

    A document is its token ids and END_ID, cut only if it is longer than
    ``capacity``.  Null or empty text is END_ID alone.
    """
    return map_batches(pick(documents, doc_id="long", text="string"), _cut(tokenizer_file, capacity),
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


# --- the plan ------------------------------------------------------------------------------------

class CapacityTree:
    """Open sequences by remaining capacity: the smallest capacity of at least n that has any."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.full = [False] * (2 * self.leaves)
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, how many)

    def _mark(self, room: int) -> None:
        node = room + self.leaves
        self.full[node] = bool(self.ranges[room])
        while node > 1:
            node >>= 1
            self.full[node] = self.full[2 * node] or self.full[2 * node + 1]

    def add(self, room: int, first: int, n: int) -> None:
        if n:
            self.ranges[room].append((first, n))
            self._mark(room)

    def take(self, room: int, most: int) -> tuple[int, int]:
        first, n = self.ranges[room].pop()
        if n > most:
            self.ranges[room].append((first + most, n - most))
            n = most
        self._mark(room)
        return first, n

    def tightest(self, least: int) -> int | None:
        node = least + self.leaves
        if self.full[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.full[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.full[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset): best fit, longest first.

    Pieces of a length from the first rank on go to the sequences from the first
    one on, so many to each, from that offset.
    """
    tree, plan, opened = CapacityTree(capacity), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            each = (capacity if room is None else room) // length
            want = max(1, left // each)  # sequences that get all they can hold; the last one may get fewer
            if room is None:
                room, first, n = capacity, opened, want
                opened += n
            else:
                first, n = tree.take(room, want)
            per = min(each, left)
            plan.append((length, rank, first, per, capacity - room))
            tree.add(room - per * length, first, n)
            rank += per * n
            left -= per * n
    return np.array(plan, np.int64).reshape(-1, 5)


def _place(plan):
    def run(batches):
        rows = plan.value
        key = (rows[:, 0] << 44) | rows[:, 1]
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            _, since, first, per, offset = rows[np.searchsorted(key, (length << 44) | rank, side="right") - 1].T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(batch.num_columns - 1)), pa.array(first + (rank - since) // per),
                 pa.array(offset + (rank - since) % per * length)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with a ``length`` of 1 to ``capacity`` -> the same rows with ``sequence_id`` and ``offset``.

    Sequences are gapless from offset 0.  ``pieces`` has doc_id, piece, start,
    length and ids_crc32 and is read several times (write it first).  Equal rows
    are placed one by one.
    """
    spark = pieces.sparkSession
    counts = {n: c for n, c in pieces.groupBy("length").count().collect()}  # capacity rows at most
    plan = spark.sparkContext.broadcast(best_fit_plan(counts, capacity))
    parts = 1 + sum(counts.values()) // RANKED_ROWS
    salted = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    before = (salted.groupBy("length", "part").count()
              .withColumn("before", F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count"))
              .select("length", "part", "before"))
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (salted.withColumn("number", number - 1).join(before, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("number")).alias("rank")))
    return ranked.mapInArrow(lean(_place(plan)), "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                           "sequence_id long, offset long")


def pack_documents(documents: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """``documents(doc_id, text)`` -> a row per piece with its place.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Null
    text is empty; null and repeated doc_ids are kept as they are; an empty table
    gives no rows.  Other columns are ignored.
    """
    return pack(store(tokenized_pieces(documents, tokenizer_file, capacity), "pieces"), capacity)
