import math
import random

import numpy as np
from pyspark.sql import functions as F

from dimforge.llm import topk as t


def plain(rows, asked, k):
    whole = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v is not None
             and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q in asked:
        if q in whole:
            s = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:k]
            out += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    return sorted(out)


def vectors(n, dims=6):
    rnd = random.Random(n)
    rows = [(i, [rnd.choice([0.0, -0.5, rnd.uniform(-1, 1)]) for _ in range(dims)]) for i in range(n)]
    return rows + [(n + 1, rows[0][1]), (n + 2, rows[0][1]), (n + 3, [0.0] * dims)]  # ties


def result(spark, rows, asked, k=5, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for c, v in more.items():
        df = df.withColumn(c, v)
    return sorted(tuple(r) for r in t.top_k(df, df.where(F.col("vec_id").isin(asked)), k).collect())


def single(rows):
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_against_all_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(t, "BLOCK_QUERIES", 3)
    monkeypatch.setattr(t, "BLOCK_CANDIDATES", 10)
    rows = vectors(70)
    asked = list(range(0, 70, 7))
    assert result(spark, rows, asked) == plain(single(rows), asked, 5)


def test_one_block_and_few_candidates(spark):
    rows = vectors(2)
    assert result(spark, rows, [0, 1], 9) == plain(single(rows), [0, 1], 9)


def test_scores_beyond_32_bits(spark):
    rows = [(i, [float(1000 + i), 2000.0, -500.0]) for i in range(8)]
    assert result(spark, rows, [0, 3], 3) == plain(rows, [0, 3], 3)


def test_many_ties_go_to_the_smaller_id(spark):
    rows = [(i, [0.5, 0.5]) for i in range(40)]
    assert result(spark, rows, [0, 39], 3) == plain(rows, [0, 39], 3)


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [None, 1.0]), (3, [math.nan, 1.0]), (4, [math.inf, 0.0]), (5, [0.25, 0.25]),
            (5, [0.25, 0.25]), (None, [1.0, 1.0]), (6, []), (7, [1.0])]
    got = result(spark, rows, [0, 1, 2], block=F.lit("x"), weights=F.lit(1), score=F.lit(0))
    assert got == plain(rows, [0], 5)


def test_empty_table(spark):
    assert result(spark, [], [0]) == []
