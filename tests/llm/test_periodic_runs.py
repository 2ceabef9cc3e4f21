import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.llm import periodic_runs as r
from dimforge.llm import queries

WORD = re.compile(r"[^ \t-\r]+")


def plain(words):
    """All runs by the definition, one period after the other."""
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            run = words[start:i + q]
            if len(run) >= max(6, 4 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                out.append((start, len(run), q))
            i = max(i, start + 1)
    return sorted(set(out), key=lambda x: (x[0], x[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_runs_of_several_texts(texts):
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    found = r.runs_of(np.array(sum(texts, []), np.int64), bounds).tolist()
    for i, t in enumerate(texts):
        assert [tuple(x[1:]) for x in found if x[0] == i] == plain(t)


@pytest.mark.parametrize("period", [*range(1, 20), 31, 32, 33, 63, 64, 65])
def test_every_period_and_alignment(period):
    rnd = random.Random(period)
    root = [rnd.randrange(9) for _ in range(period - 1)] + [10]
    least = max(6, 4 * period)
    for before in range(0, 2 * period + 4, 1 + period // 8):
        for length in (least - 1, least, least + 3):
            words = [100 + i for i in range(before)] + [root[i % period] for i in range(length)] + [99]
            found = r.runs_of(np.array(words), np.array([0, len(words)])).tolist()
            assert ([0, before, length, period] in found) == (length >= least)


def test_wavelet_tree_successors():
    rnd = np.random.default_rng(2)
    values = rnd.permutation(300)
    tree = r.WaveletTree(values)
    low = rnd.integers(0, 300, 2000)
    high = np.minimum(300, low + rnd.integers(0, 40, 2000))
    least = rnd.integers(0, 600, 2000)
    want = [min((v for v in values[a:b].tolist() if v >= x), default=-1)
            for a, b, x in zip(low.tolist(), high.tolist(), least.tolist(), strict=True)]
    assert tree.successor(low, high, least).tolist() == want


def test_suffix_classes():
    rnd = random.Random(3)
    line = np.array([rnd.randrange(3) for _ in range(80)] + [9])
    s = r.SuffixClasses(line)
    text = line.tolist()
    assert s.order.tolist() == sorted(range(81), key=lambda i: text[i:])
    for k, c in enumerate(s.classes):
        for i in range(81):
            for j in range(i):
                assert (c[i] == c[j]) == (text[i:i + 2**k] == text[j:j + 2**k])


def test_long_texts_take_near_linear_time():
    for words in ([0] * 300_000, [i % 1000 for i in range(300_000)], [0, 1] * 150_000):
        found = r.runs_of(np.array(words), np.array([0, len(words)])).tolist()
        assert found == [[0, 0, len(words), len(set(words))]]


def test_find_runs_with_odd_rows_and_columns(spark):
    rows = [(1, "a b a b a b a b c"), (2, None), (3, ""), (4, " \t\n "), (None, "x x x x x x"), (1, "a b a b a b a b c"),
            (5, " ".join(["na"] * 5)), (6, "é\x0bé\x0cé\ré\té\né"), (7, "a a a a"), (8, "t " * 50_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("start", F.lit("x"))
    got = sorted(((x.doc_id, x.n_words, [tuple(y) for y in x.runs], x.collapsed) for x in r.find_runs(df).collect()), key=str)
    want = []
    for i, t in rows:
        w = WORD.findall(t or "")
        runs = [(0, 50_000, 1)] if i == 8 else plain(w)
        want.append((i, len(w), runs, collapsed(w, runs)))
    assert got == sorted(want, key=str)
    assert r.find_runs(df.where("doc_id > 99")).collect() == []


def test_registered_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["do", "re", "mi", "fa", "so"]) for _ in range(rnd.randrange(90)))) for i in range(150)]
    rows += [(200, None), (None, "a a a a a a a"), (201, "x  " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(x) for x in queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want, planted = [], 0
    for i, t in rows:
        w = WORD.findall(t or "")
        h = 1 if i is None else zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = w[:a] + [w[a + k % p] for k in range(len(w) - a)]
            planted += 1
        runs = plain(w)
        start, length, period = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((i, len(runs), start, length, period, length and 1000 * length // period,
                     hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    assert got == sorted(want, key=str) and planted > 5
