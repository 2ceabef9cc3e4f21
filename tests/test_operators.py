"""Validity join, CDC, delta maintenance, quality checks, dedup, calendar."""

import datetime as dt
import json
import random
from decimal import Decimal

from pyspark.sql import functions as F

from dimforge.operators import calendar as cal
from dimforge.operators import cdc
from dimforge.operators import incremental as inc
from dimforge.operators import quality as Q
from dimforge.operators.dedup import last_state_per_key, latest_per_key
from dimforge.operators.joins import validity_join

DIM_SCHEMA = "sk string, id bigint, version int, valid_from date, valid_to date, is_current string"


def d(s):
    return dt.date.fromisoformat(s)


def test_validity_join_half_open(spark):
    dim = spark.createDataFrame([("a1", 2, 1, d("1900-01-01"), d("2025-07-08"), "N"),
                                 ("a2", 2, 2, d("2025-07-08"), None, "Y")], DIM_SCHEMA)
    pays = spark.createDataFrame([(10, 2, d("2025-07-05")), (11, 2, d("2025-07-08")), (12, 2, d("2026-01-01")),
                                  (13, 9, d("2025-07-05"))], "pid int, emp bigint, paid date")
    out = validity_join(pays, dim, "emp", F.col("paid"), "id")
    got = sorted((r.pid, r.v_version) for r in out.collect())
    assert got == [(10, 1), (11, 2), (12, 2)]     # boundary day belongs to the new version; no match dropped


def test_snapshot_diff_and_audit(spark):
    old = spark.createDataFrame([(1, "a", Decimal("1.00")), (2, "b", Decimal("2.00")), (3, "c", None)],
                                "id bigint, s string, v decimal(18,2)")
    new = spark.createDataFrame([(1, "a", Decimal("1.00")), (2, "b", Decimal("2.50")), (4, "d", Decimal("4.00")),
                                 (3, "c", Decimal("0.00"))], "id bigint, s string, v decimal(18,2)")
    diff = cdc.snapshot_diff(old, new, ["id"])
    assert sorted((r.id, r.action) for r in diff.collect()) == [(2, "U"), (3, "U"), (4, "I")]
    gone = cdc.snapshot_diff(new, old, ["id"]).filter("action = 'D'").select("id").first()[0]
    assert gone == 4
    log = cdc.audit_log(diff, "src", "t", F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    r = log.filter("action = 'U' AND original_data LIKE '%\"id\":3%'").first()
    assert json.loads(r.original_data) == {"id": 3, "s": "c", "v": None}
    ins = cdc.typed_delta(diff, "I")
    assert ins.columns == ["id", "s", "v"] and ins.count() == 1


def test_quarantine_keeps_every_row(spark):
    feed = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0)], "id int, value double")
    ok, bad = cdc.split_quarantine(feed, F.col("value") >= 0, F.lit("bad value"))
    assert ok.count() + bad.count() == feed.count() and bad.count() == 2


def test_append_new_is_idempotent(spark):
    stored = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    delta = spark.createDataFrame([(2, "y"), (3, "z")], "k int, v string")
    new = inc.append_new(stored, delta, ["k"])
    assert [r.k for r in new.collect()] == [3]
    after = stored.unionByName(new)
    assert inc.append_new(after, delta, ["k"]).count() == 0


def test_replace_by_key_and_except(spark):
    stored = spark.createDataFrame([(1, "old"), (2, "same")], "k int, v string")
    rebuilt = spark.createDataFrame([(1, "new"), (2, "same"), (3, "added")], "k int, v string")
    affected = spark.createDataFrame([(1,), (3,), (3,)], "k int")     # changed key and new key
    out = inc.replace_by_key(stored, rebuilt, ["k"], affected)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "new"), (2, "same"), (3, "added")]
    # only affected keys are replaced: a rebuilt row outside the set is ignored
    other = spark.createDataFrame([(1, "new"), (2, "recomputed")], "k int, v string")
    out = inc.replace_by_key(stored, other, ["k"], affected)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "new"), (2, "same")]
    assert sorted(tuple(r) for r in inc.except_delta(rebuilt, stored).collect()) == [(1, "new"), (3, "added")]


def test_overlap_check_equals_pairwise(spark):
    rng = random.Random(7)
    rows = []
    for key in range(30):
        start = 0
        for v in range(1, rng.randint(2, 5)):
            s = start + rng.randint(-2, 3)
            e = s + rng.randint(0, 4) if rng.random() < 0.8 else None
            rows.append((f"{key}-{v}", key, v, d("2025-01-01") + dt.timedelta(days=s),
                         None if e is None else d("2025-01-01") + dt.timedelta(days=e), "N"))
            start = s + 2
    rows = [r for r in rows if r[4] is None or r[4] >= r[3]]
    df = spark.createDataFrame(rows, DIM_SCHEMA)
    far = d("9999-12-31")
    want = set()
    for b in rows:
        covers = [a for a in rows if a[1] == b[1] and (a[3], a[2]) < (b[3], b[2])
                  and b[3] < (a[4] or far) and a[3] < (b[4] or far)]
        if covers:
            want.add((b[1], max(covers, key=lambda a: (a[4] or far, a[2]))[2], b[2]))
    got = {tuple(r) for r in Q.overlapping_validity(df, "id").collect()}
    assert got == want and want


def test_overlap_across_a_closed_version(spark):
    rows = [("a", 1, 1, d("2025-01-01"), d("2025-12-01"), "N"), ("b", 1, 2, d("2025-02-01"), d("2025-03-01"), "N"),
            ("c", 1, 3, d("2025-05-01"), d("2025-06-01"), "N")]
    got = sorted(tuple(r) for r in Q.overlapping_validity(spark.createDataFrame(rows, DIM_SCHEMA), "id").collect())
    assert got == [(1, 1, 2), (1, 1, 3)]


def test_dedup_forms_agree(spark):
    rng = random.Random(3)
    data = [(rng.randint(0, 9), i, rng.randint(0, 5), f"v{i}") for i in range(300)]
    df = spark.createDataFrame(data, "k int, seq int, ts int, val string")
    a = latest_per_key(df, ["k"], [F.col("ts").desc(), F.col("seq").desc()]).select("k", "val")
    b = last_state_per_key(df, ["k"], ["ts", "seq"], ["val"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_calendar_only_unseen_dates(spark):
    ts = spark.createDataFrame([(dt.datetime(2025, 7, 8, 23, 10),), (dt.datetime(2025, 7, 8, 1, 0),),
                                (dt.datetime(2025, 7, 9, 0, 0),)], "t timestamp_ntz")
    dates = cal.seen_dates([(ts, "t")])
    stored = cal.calendar_rows(dates.filter(F.col("date") == F.lit(d("2025-07-08"))))
    new = cal.unseen_calendar_rows(dates, stored).collect()
    assert [(r.full_date, r.weekday, r.month, r.quarter) for r in new] == [(d("2025-07-09"), "WED", "07", 3)]
    assert dates.count() == 2


def test_compare_counts_multiset_differences(spark):
    from dimforge.plans.load import compare
    pub = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c")], "k int, v string")
    reb = spark.createDataFrame([(1, "a"), (2, "b"), (3, "d"), (None, "c")], "k int, v string")
    got = {r.name: r.n_rows for r in compare("t", pub, reb).collect()}
    assert got == {"t.rows": 4, "t.extra": 1, "t.missing": 1}
    # same as exceptAll both ways
    assert pub.exceptAll(reb).count() == 1 and reb.exceptAll(pub).count() == 1
    empty = spark.createDataFrame([], "k int, v string")
    assert {r.name: r.n_rows for r in compare("e", empty, empty).collect()} == {"e.rows": 0, "e.extra": 0,
                                                                                 "e.missing": 0}


def test_equal_tables_are_compared_without_moving_their_rows(spark):
    from dimforge.plans.load import compare
    rows = spark.createDataFrame([(i, None if i % 3 else "x", i % 5) for i in range(500)] * 2, "k long, s string, v int")
    same = compare("t", rows, rows.repartition(3))
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
    assert {r.name: r.n_rows for r in same.collect()} == {"t.rows": 1000, "t.extra": 0, "t.missing": 0}
    # a null that changes its column, and a row once more
    other = rows.where("k <> 7").unionByName(spark.createDataFrame([(7, None, 2), (7, None, 2), (9, None, 4)], "k long, s string, v int"))
    moved = spark.createDataFrame([(1, None, 2)], "k long, s string, v int"), spark.createDataFrame([(None, "x", 2)], "k long, s string, v int")
    assert {r.name: r.n_rows for r in compare("t", rows, other).collect()} == {"t.rows": 1000, "t.extra": 0, "t.missing": 1}
    assert {r.name: r.n_rows for r in compare("t", *moved).collect()} == {"t.rows": 1, "t.extra": 1, "t.missing": 1}
