"""SCD type 2 / type 1 on purpose-built feeds, plus a property test:
applying daily batches one by one equals the one-pass history, and both
equal a brute-force Python model."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimforge.operators import quality as Q
from dimforge.operators.scd import (Scd2Spec, scd1_overwrite, scd2_apply, scd2_apply_batches,
                                    scd2_close, scd2_history, scd2_initial)

SPEC = Scd2Spec("emp", "id", ("name",), ("category", "salary"))
SRC_SCHEMA = "id bigint, name string, category string, salary decimal(18,2)"
CH_SCHEMA = "id bigint, ts timestamp_ntz, seq bigint, category string, salary decimal(18,2)"


def d(s):
    return dt.date.fromisoformat(s)


def t(s):
    return dt.datetime.fromisoformat(s)


def initial(spark):
    src = spark.createDataFrame([(1, "Ana", "Office", Decimal("3000.00")),
                                 (2, "Bruno", "Driver", Decimal("3800.00")),
                                 (3, "Carla", "Driver", Decimal("3500.00"))], SRC_SCHEMA)
    return scd2_initial(src, SPEC)


def rows(df):
    return sorted((r.id, r.version, r.category, str(r.salary), r.valid_from, r.valid_to, r.is_current)
                  for r in df.collect())


def test_apply_one_batch(spark):
    ch = spark.createDataFrame([
        (2, t("2025-07-08 10:00:00"), 1, "Driver", Decimal("4560.00")),   # raise -> v2
        (3, t("2025-07-08 09:00:00"), 2, "Office", Decimal("3500.00")),   # category -> v2
        (1, t("2025-07-08 09:00:00"), 3, "Office", Decimal("3000.00")),   # no type-2 change
        (4, t("2025-07-08 11:00:00"), 4, "Driver", Decimal("2000.00")),   # newcomer -> v1
    ], CH_SCHEMA)
    out = scd2_apply(initial(spark), ch, SPEC, "ts", "seq")
    assert rows(out) == [
        (1, 1, "Office", "3000.00", d("1900-01-01"), None, "Y"),
        (2, 1, "Driver", "3800.00", d("1900-01-01"), d("2025-07-08"), "N"),
        (2, 2, "Driver", "4560.00", d("2025-07-08"), None, "Y"),
        (3, 1, "Driver", "3500.00", d("1900-01-01"), d("2025-07-08"), "N"),
        (3, 2, "Office", "3500.00", d("2025-07-08"), None, "Y"),
        (4, 1, "Driver", "2000.00", d("1900-01-01"), None, "Y"),
    ]
    # type-1 attribute carried to the new version
    assert {r.name for r in out.filter("id = 2").collect()} == {"Bruno"}


def test_batch_collapses_to_last_state(spark):
    """A -> B -> A inside one batch opens nothing; ties broken by sequence."""
    ch = spark.createDataFrame([
        (2, t("2025-07-08 10:00:00"), 1, "Office", Decimal("3800.00")),
        (2, t("2025-07-08 11:00:00"), 2, "Driver", Decimal("3800.00")),
        (3, t("2025-07-09 10:00:00"), 3, "Office", Decimal("1.00")),
        (3, t("2025-07-09 10:00:00"), 4, "Office", Decimal("2.00")),
    ], CH_SCHEMA)
    out = scd2_apply(initial(spark), ch, SPEC, "ts", "seq")
    assert out.filter("id = 2").count() == 1
    v2 = out.filter("id = 3 AND version = 2").first()
    assert v2.salary == Decimal("2.00")


def test_checks_pass_and_close(spark):
    ch = spark.createDataFrame([
        (2, t("2025-07-08 10:00:00"), 1, "Driver", Decimal("4560.00")),
        (2, t("2025-07-10 10:00:00"), 2, "Office", Decimal("4560.00")),
    ], CH_SCHEMA)
    hist = scd2_history(initial(spark), ch, SPEC, "ts", "seq", F.to_date("ts"))
    assert Q.multiple_current(hist, "id").count() == 0
    assert Q.current_flag_inconsistent(hist, "id").count() == 0
    assert Q.overlapping_validity(hist, "id").count() == 0
    assert Q.end_before_start(hist).count() == 0
    assert Q.duplicate_keys(hist, ["id", "version"]).count() == 0
    reopened = hist.withColumn("valid_to", F.lit(None).cast("date")).withColumn("is_current", F.lit("Y"))
    assert rows(scd2_close(reopened, SPEC)) == rows(hist)


def test_type1_overwrites_all_versions(spark):
    ch = spark.createDataFrame([(2, t("2025-07-08 10:00:00"), 1, "Driver", Decimal("4560.00"))], CH_SCHEMA)
    dim = scd2_apply(initial(spark), ch, SPEC, "ts", "seq")
    src = spark.createDataFrame([(1, "Ana S."), (2, "Bruno L.")], "id bigint, name string")
    keys = spark.createDataFrame([(2,)], "id bigint")
    out = scd1_overwrite(dim, src, "id", ("name",), keys)
    assert {r.name for r in out.filter("id = 2").collect()} == {"Bruno L."}
    assert out.filter("id = 1").first().name == "Ana"           # not in the delta
    assert out.count() == dim.count()


def brute_force(init_rows, changes):
    """Plain-Python model of daily batches applied in order."""
    dims = {i: [dict(version=1, cat=c, sal=s, start=d("1900-01-01"), end=None)] for i, c, s in init_rows}
    by_day = {}
    for (i, ts, seq, c, s) in changes:
        by_day.setdefault(ts.date(), []).append((ts, seq, i, c, s))
    for day in sorted(by_day):
        last = {}
        for ts, seq, i, c, s in sorted(by_day[day]):
            last[i] = (c, s, ts.date())
        for i, (c, s, cd) in last.items():
            if i not in dims:
                dims[i] = [dict(version=1, cat=c, sal=s, start=d("1900-01-01"), end=None)]
                continue
            cur = dims[i][-1]
            if (cur["cat"], cur["sal"]) != (c, s):
                cur["end"] = cd
                dims[i].append(dict(version=cur["version"] + 1, cat=c, sal=s, start=cd, end=None))
    out = []
    for i, vs in dims.items():
        for v in vs:
            out.append((i, v["version"], v["cat"], str(v["sal"]), v["start"], v["end"],
                        "Y" if v["end"] is None else "N"))
    return sorted(out)


change = st.tuples(st.integers(1, 5), st.integers(1, 4), st.integers(0, 23),
                   st.sampled_from(["Office", "Driver"]), st.sampled_from(["1.00", "2.00"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(change, min_size=1, max_size=12))
def test_daily_batches_equal_history_and_model(spark, feed):
    init_rows = [(1, "Office", Decimal("1.00")), (2, "Driver", Decimal("2.00")), (3, "Office", Decimal("2.00"))]
    src = spark.createDataFrame([(i, f"n{i}", c, s) for i, c, s in init_rows], SRC_SCHEMA)
    changes = [(i, dt.datetime(2025, 1, day, hour), n, c, Decimal(s))
               for n, (i, day, hour, c, s) in enumerate(feed)]
    ch = spark.createDataFrame(changes, CH_SCHEMA)
    init = scd2_initial(src, SPEC)
    one_pass = rows(scd2_history(init, ch, SPEC, "ts", "seq", F.to_date("ts")))
    dim = init
    for day in sorted({c[1].date() for c in changes}):
        dim = scd2_apply(dim, ch.filter(F.to_date("ts") == F.lit(day)), SPEC, "ts", "seq")
    assert rows(dim) == one_pass
    assert one_pass == brute_force(init_rows, changes)
    # two rounds of batches from a published state give the same end state
    cut = dt.datetime(2025, 1, 3)
    first = scd2_apply_batches(init, ch.filter(F.col("ts") < cut), SPEC, "ts", "seq", F.to_date("ts"))
    second = scd2_apply_batches(first, ch.filter(F.col("ts") >= cut), SPEC, "ts", "seq", F.to_date("ts"))
    assert rows(second) == one_pass


def test_late_changes_are_quarantined(spark):
    ch = spark.createDataFrame([(2, t("2025-07-08 10:00:00"), 1, "Driver", Decimal("4560.00"))], CH_SCHEMA)
    dim = scd2_apply(initial(spark), ch, SPEC, "ts", "seq")          # id 2 current since 2025-07-08
    from dimforge.operators.scd import split_late_changes
    feed = spark.createDataFrame([
        (2, t("2025-07-07 09:00:00"), 5, "Office", Decimal("1.00")),   # before current start -> late
        (2, t("2025-07-08 18:00:00"), 6, "Office", Decimal("1.00")),   # same day -> on time
        (3, t("2025-01-01 00:00:00"), 7, "Office", Decimal("1.00")),   # v1 open since 1900 -> on time
        (9, t("2025-01-01 00:00:00"), 8, "Office", Decimal("1.00")),   # unknown member -> on time
    ], CH_SCHEMA)
    ok, late = split_late_changes(dim, feed, SPEC, "ts")
    assert [r.seq for r in late.collect()] == [5]
    assert sorted(r.seq for r in ok.collect()) == [6, 7, 8]
