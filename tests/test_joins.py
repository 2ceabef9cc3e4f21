"""The merge of events and versions against the validity join and against a search in sorted lists."""

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from dimforge.operators.joins import validity_join, validity_merge

DAY = dt.datetime(2024, 1, 1)
DIM = "id long, version int, valid_from timestamp, valid_to timestamp"


def _history(rnd, key, hours):
    """Versions one after the other, with gaps, an empty one, and the last open or closed."""
    at, out = 0, []
    for version in range(rnd.randint(0, 6)):
        at += rnd.choice((0, 0, 5, 700))
        end = at + rnd.choice((0, 1, 30, 900))
        out.append((key, version, DAY + dt.timedelta(hours=at), DAY + dt.timedelta(hours=end)))
        at = end
    if out and rnd.random() < .5 and out[-1][2] < out[-1][3]:
        out[-1] = (*out[-1][:3], None)
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("span_days", [1, 31])
def test_merge_equals_join(spark, how, span_days):
    rnd = random.Random(span_days)
    dim = [v for key in range(12) for v in _history(rnd, key, 3000)]
    dim += [(None, 9, DAY, None), (3, 8, None, None)]
    starts = [v[2] for v in dim if v[2]] + [v[3] for v in dim if v[3]]
    facts = [(i, rnd.choice((*range(13), None)), rnd.choice((*starts, None, DAY + dt.timedelta(hours=rnd.randrange(4000)))))
             for i in range(600)]
    facts += facts[:20]
    d = spark.createDataFrame(dim, DIM)
    f = spark.createDataFrame(facts, "n long, _k long, _t timestamp")
    want = validity_join(f, d, "_k", F.col("_t"), "id", how)
    got = validity_merge(f, d, "_k", F.col("_t"), "id", how, span_days=span_days)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_empty_sides(spark):
    d = spark.createDataFrame([], DIM)
    f = spark.createDataFrame([(1, 1, DAY)], "n long, k long, t timestamp")
    assert validity_merge(f, d, "k", F.col("t"), "id").collect() == []
    assert [r.v_version for r in validity_merge(f, d, "k", F.col("t"), "id", "left").collect()] == [None]
    assert validity_merge(f.limit(0), d, "k", F.col("t"), "id", "left").collect() == []


def test_a_long_history_is_spread_over_tasks(spark):
    versions, events = 10_000, 200_000
    hour = F.timestamp_seconds(F.lit(int(DAY.replace(tzinfo=dt.timezone.utc).timestamp())) + F.col("id") * 3600)
    d = spark.range(versions).select(F.lit(7).cast("long").alias("id"), F.col("id").alias("version"), hour.alias("valid_from"),
                                     F.when(F.col("id") < versions - 1, F.timestamp_seconds(F.unix_seconds(hour) + 3600))
                                     .alias("valid_to"))
    f = spark.range(events).select(F.col("id").alias("n"), F.lit(7).cast("long").alias("k"),
                                   F.timestamp_seconds(F.lit(int(DAY.replace(tzinfo=dt.timezone.utc).timestamp()))
                                                       + F.col("id") * 181).alias("t"))
    out = validity_merge(f, d, "k", F.col("t"), "id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    rows = out.select("n", "v_version", F.spark_partition_id().alias("task")).collect()
    starts = [3600 * v for v in range(versions)]
    assert len(rows) == events and all(r.v_version == bisect.bisect_right(starts, r.n * 181) - 1 for r in rows)
    by_task = {}
    for r in rows:
        by_task[r.task] = by_task.get(r.task, 0) + 1
    assert len(by_task) > 1 and max(by_task.values()) < events
