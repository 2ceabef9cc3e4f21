import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from dimforge.llm import packing
from dimforge.llm.queries import tokenizer_file


def naive_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_plan_is_best_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(60):
        capacity = rnd.choice([10, 64, 100])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, placed = {}, 0
        for length, rank, first, per, offset in packing.best_fit_plan(counts, capacity).tolist():
            after = [r for n, r, *_ in packing.best_fit_plan(counts, capacity).tolist() if n == length and r > rank]
            n = min(after, default=counts[length]) - rank
            for k in range(n):
                s = first + k // per
                assert used.get(s, 0) == offset + k % per * length
                used[s] = used.get(s, 0) + length
            placed += n
        assert placed == len(lengths)
        assert sorted(capacity - u for u in used.values()) == naive_best_fit(lengths, capacity)


def test_tree_finds_the_tightest_room():
    rnd = random.Random(3)
    tree, rooms = packing.CapacityTree(50), {}
    for step in range(500):
        if rooms and rnd.random() < .5:
            least = rnd.randint(0, 50)
            assert tree.tightest(least) == min((r for r in rooms if r >= least), default=None)
        else:
            r = rnd.randint(0, 50)
            tree.add(r, step, 1)
            rooms[r] = rooms.get(r, 0) + 1
        if rooms and rnd.random() < .4:
            r = rnd.choice(list(rooms))
            tree.take(r, 1)
            rooms[r] -= 1
            if not rooms[r]:
                del rooms[r]


TEXTS = ["Hello, world. It's 25 o'clock...", "", None, "<|endoftext|> and <|StartOfText|> A.", "don't. can't, WON'T", "é É ß İ  x\x0by",
         "a.b, c.", "x" * 3000, "日本語 テキスト.", "word. " * 6000, "stop!!? a,b,, c.d!x", "word!!<|endoftext|>!!", "x!\u00e9!!", "it's,' can't'", "A-B-- 1-- \u00e9--","...", ", . a", "é. café,"]


def test_ids_are_the_tokenizers():
    words = packing.WordIds(tokenizer_file())
    for texts in (TEXTS, TEXTS[4:], ["one", "two. <|endoftext|>"]):
        ids, bounds = words.encode(pa.array(texts, pa.string()))
        for k, t in enumerate(texts):
            want = words.tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
            assert ids[bounds[k]:bounds[k + 1]].tolist() == want, t


def test_pieces_are_packed_without_gaps(spark):
    rows = [*enumerate(TEXTS), (3, TEXTS[3]), (None, "no id"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rank", F.lit("x")).withColumn(
        "length", F.lit(9)).withColumn("part", F.lit(0))
    got = packing.pack_documents(df, tokenizer_file()).collect()
    words = packing.WordIds(tokenizer_file())
    want = []
    for i, t in rows:
        ids = words.tokenizer.encode(t or "", add_special_tokens=False).ids + [packing.END_ID]
        for k in range(0, len(ids), packing.CAPACITY):
            part = np.array(ids[k:k + packing.CAPACITY], "<u4")
            want.append((i, k // packing.CAPACITY, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), tokenizer_file()).collect() == []
