import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimforge.llm import hard_negatives as h

SCHEMA = "vec_id long, label int, embedding array<float>"


def plain(rows, asked, positives=5, negatives=3):
    least = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            least[i] = min(least.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in least.items()}
    out = []
    for a in asked:
        if a not in whole:
            continue
        label, q = whole[a]
        score = {i: min(max(sum(x * y for x, y in zip(q, v, strict=False)), -2**63), 2**63 - 1)
                 for i, (_, v) in whole.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if whole[i][0] == label][:positives]:
            s = score[p]
            fit = [i for i in order if whole[i][0] != label and 50 * s <= 100 * score[i] <= 95 * s][:negatives]
            out += [(a, p, k + 1, i, s, score[i]) for k, i in enumerate(fit)]
    return sorted(out)


def single(rows):
    return [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]


def result(spark, rows, asked, **more):
    df = spark.createDataFrame(rows, SCHEMA)
    for c, v in more.items():
        df = df.withColumn(c, v)
    return sorted(tuple(r) for r in h.mine_hard_negatives(df, df.where(F.col("vec_id").isin(asked))).collect())


def vectors(n, dims, labels, seed):
    rnd = random.Random(seed)
    middle = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(labels)]
    return [(i, rnd.randrange(labels), [x + rnd.uniform(-1, 1) for x in rnd.choice(middle)]) for i in range(n)]


@pytest.mark.parametrize(("dims", "labels"), [(3, 2), (20, 3), (64, 40)])
def test_against_all_pairs_in_small_cells(spark, monkeypatch, dims, labels):
    monkeypatch.setattr(h, "CELL", 40)
    monkeypatch.setattr(h, "BLOCK_ANCHORS", 4)
    rows = vectors(200, dims, labels, dims)
    asked = list(range(0, 200, 9))
    got = result(spark, rows, asked)
    assert got == plain(single(rows), asked) and got


def test_a_hot_label_and_ties(spark, monkeypatch):
    monkeypatch.setattr(h, "CELL", 16)
    rows = [(i, 0 if i % 3 else 1, [0.5, 0.25 + (i % 4) / 8]) for i in range(100)]
    asked = [0, 1, 50]
    got = result(spark, rows, asked)
    assert got == plain(single(rows), asked) and got


def test_bounds_hold_and_leave_few_rows():
    rnd = np.random.default_rng(1)
    middle = np.repeat(rnd.normal(0, 60, (20, 8)), 8, axis=1)  # components next to each other are alike
    found = np.floor(middle[rnd.integers(0, 20, 4000)] + rnd.normal(0, 6, (4000, 64)))
    cell = h.Cell(np.arange(4000), np.zeros(4000, np.int64), found)
    asked = h.Summaries(found[:5])
    score = found @ found[:5].T
    for n in range(5):
        mine = [(m[n], d[n]) for m, d in asked.levels]
        for level in range(len(mine)):
            least, largest = cell.summaries.bounds(level, mine, np.arange(4000), 1.0)
            assert (least <= score[:, n]).all() and (score[:, n] <= largest).all()
        exact = []
        kind = type(cell)
        original = kind.exact
        kind.exact = lambda self, a, rows, to=exact: to.append(len(rows)) or original(self, a, rows)
        cell.best(n, 0, found[n], mine, 5)
        kind.exact = original
        assert sum(exact) < 1000


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.75, 0.25]), (3, 2, None), (4, 2, [None, 1.0]),
            (5, 2, [math.nan, 1.0]), (6, 2, [math.inf, 1.0]), (7, None, [1.0, 1.0]), (None, 2, [0.75, 0.25]),
            (8, 2, [0.75, 0.25]), (8, 2, [0.75, 0.25]), (8, 3, [0.7, 0.25]), (9, 2, []), (10, 2, [0.9]), (11, 1, [-1.0, 0.0])]
    got = result(spark, rows, [0, 3, 7, 8, 11], key=F.lit("x"), group=F.lit(1), scores=F.lit(0), score=F.lit(0))
    assert got == plain(single(rows), [0, 8, 11]) and got


def test_zero_and_negative_positive_scores(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [0.0, 1.0]), (2, 1, [-1.0, 0.0]), (3, 2, [0.0, 2.0]), (4, 2, [-0.7, 0.0]), (5, 2, [0.6, 0.0])]
    assert result(spark, rows, [0]) == plain(rows, [0])


def test_scores_beyond_64_bits(spark):
    rows = [(i, i % 2, [10.0 ** (12 + i), -3.0, 1e30 * (i == 7)]) for i in range(8)]
    assert result(spark, rows, [0, 1, 7]) == plain(single(rows), [0, 1, 7])


def test_empty_table_and_single_row(spark):
    assert result(spark, [], [0]) == []
    assert result(spark, [(0, 1, [1.0])], [0]) == []
