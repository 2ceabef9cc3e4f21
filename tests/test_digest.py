import random

from dimforge.operators import digest as D

SCHEMA = "k long, j int, v string, w double"


def table(rnd, n):
    return [(rnd.choice([None, *range(30)]), rnd.randint(0, 2), rnd.choice([None, "a", "b"]), rnd.choice([None, 0.5, 1.5]))
            for _ in range(n)]


def found(spark, a, b, **more):
    frames = [spark.createDataFrame(x, SCHEMA) for x in (a, b)]
    return {(r["side"], *(r[c] for c in ("k", "j", "v", "w"))) for r in D.differences(*frames, ["k", "j"], **more).collect()}


def test_equals_except_both_ways(spark):
    rnd = random.Random(3)
    a = table(rnd, 200)
    b = [r for r in a if rnd.random() > 0.05] + table(rnd, 5)
    want = {("left", *r) for r in set(a) - set(b)} | {("right", *r) for r in set(b) - set(a)}
    assert want and found(spark, a, b, levels=(4, 16)) == want


def test_nulls_repeats_and_empty_tables(spark):
    a = [(1, 1, None, 0.5), (1, 1, "x", None), (2, 1, "y", 1.5)]
    assert found(spark, a, a) == set() == found(spark, [], []) == found(spark, a + a[:2], a)  # repeats are no difference
    assert found(spark, a, [(1, 1, "x", None), *a[:1]]) == {("left", *a[2])}
    assert found(spark, [(None, 1, "x", None)], [(1, None, "x", None)]) == {("left", None, 1, "x", None), ("right", 1, None, "x", None)}
    assert found(spark, a, []) == {("left", *r) for r in a}
    # two equal rows against two others: sums tell them apart
    assert found(spark, [a[0]] * 2, [a[1]] * 2) == {("left", *a[0]), ("right", *a[1])}


def test_equal_buckets_give_no_rows_to_compare(spark):
    rows = [(i, 0, "v", 1.0) for i in range(300)]
    changed = [(i, 0, "other" if i == 7 else "v", 1.0) for i in range(300)]
    assert found(spark, rows, changed) == {("left", *rows[7]), ("right", *changed[7])}
    plan = D.differences(*(spark.createDataFrame(x, SCHEMA) for x in (rows, changed)), ["k"])._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
