"""Plan-shape checks for scale: partial aggregation / top-1 below the
shuffle, pruned scans, and correctness when one key holds a third of rows."""

import contextlib
import datetime as dt
import io
from decimal import Decimal

from pyspark.sql import functions as F

from dimforge.operators.dedup import last_state_per_key, latest_per_key
from dimforge.operators.scd import Scd2Spec, scd2_apply, scd2_history, scd2_initial
from dimforge.plans.warehouse import Warehouse
from tests.conftest import SF_SMALL


def plan_text(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def tree(plan):
    return plan.split("\n\n")[0]


def test_latest_per_key_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    t = tree(plan_text(latest_per_key(df, ["k"], [F.col("ts").desc()])))
    lines = t.splitlines()
    ex = max(i for i, l in enumerate(lines) if "Exchange" in l)
    assert any("WindowGroupLimit" in l for l in lines[ex + 1:]), t   # partial top-1 under the exchange


def test_last_state_combines_map_side(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"),
                                  F.col("id").cast("string").alias("v"))
    p = plan_text(last_state_per_key(df, ["k"], ["ts"], ["v"]))
    lines = tree(p).splitlines()
    ex = max(i for i, l in enumerate(lines) if "Exchange" in l)
    assert any("Aggregate" in l for l in lines[ex + 1:]), p


def test_fact_scan_is_pruned(spark):
    p = plan_text(Warehouse(spark, SF_SMALL).revenue_fact)
    schemas = [l for l in p.splitlines() if l.startswith("ReadSchema") and "l_orderkey" in l]
    assert schemas and all("l_quantity" not in s and "l_tax" not in s for s in schemas), schemas


def test_hot_key_holding_a_third_of_the_feed(spark):
    """Member 1 carries a third of all changes; results equal per-day batches."""
    spec = Scd2Spec("m", "id", ("name",), ("seg", "amt"))
    src = spark.createDataFrame([(i, f"n{i}", "A", Decimal("1.00")) for i in range(1, 31)],
                                "id bigint, name string, seg string, amt decimal(18,2)")
    rows = []
    for n in range(900):
        member = 1 if n % 3 == 0 else 2 + n % 29
        rows.append((member, dt.datetime(2025, 1, 1 + n % 5, n % 24, n % 60), n, "AB"[n % 2],
                     Decimal(n % 4)))
    ch = spark.createDataFrame(rows, "id bigint, ts timestamp_ntz, seq bigint, seg string, amt decimal(18,2)")
    init = scd2_initial(src, spec)
    one = scd2_history(init, ch, spec, "ts", "seq", F.to_date("ts"))
    dim = init
    for day in range(1, 6):
        dim = scd2_apply(dim, ch.filter(F.dayofmonth("ts") == day), spec, "ts", "seq")
    key = lambda df: sorted((r.id, r.version, r.seg, str(r.amt), r.valid_from, r.valid_to) for r in df.collect())
    assert key(one) == key(dim)
    assert one.filter("id = 1").count() <= 6          # at most one version per daily batch + initial


def test_revenue_by_origin_keeps_the_fact_row_set(spark):
    """Early aggregation per order gives the same per-address totals as
    grouping the revenue fact, also when boardings lose their supplier and
    orders lose their customer / member (inner joins drop them in both)."""
    w = Warehouse(spark, SF_SMALL, filters={"supplier": F.col("s_suppkey") % 3 != 0,
                                            "customer": F.col("c_custkey") % 5 != 0})
    fast = w.revenue_by_origin()
    slow = w.revenue_fact.groupBy("origin_address_key").agg(F.count(F.lit(1)).alias("n"),
                                                           F.sum("paid").alias("amt"))
    cols = ["origin_address_key", "n", "amt"]
    a = fast.select(*cols, F.col("amt").cast("decimal(38,2)").alias("amt2")).drop("amt")
    b = slow.select(*cols, F.col("amt").cast("decimal(38,2)").alias("amt2")).drop("amt")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    full = Warehouse(spark, SF_SMALL).revenue_fact.count()
    assert w.revenue_fact.count() < full          # the fixture really drops rows


def boarding_grain_exchanges(df):
    """Shuffles of un-aggregated lineitem rows in the physical plan."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    n = 0
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" not in line or "Aggregate" in lines[i + 1]:
            continue
        leaf = next(x for x in lines[i + 1:] if "FileScan" in x)
        n += "lineitem" in leaf
    return n


def test_boarding_grain_shuffles_at_cluster_sizes(spark):
    """With broadcasts off (dimensions too large, as on a cluster): the revenue
    fact and the revenue mart shuffle boardings twice, the cross-tabs no more,
    and the penetration mart once."""
    from dimforge.plans import registry as R
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        assert boarding_grain_exchanges(Warehouse(spark, SF_SMALL).revenue_fact) == 2
        assert boarding_grain_exchanges(R.QUERIES["mart_penetration"](spark, SF_SMALL)) == 1
        assert boarding_grain_exchanges(R.QUERIES["mart_revenue"](spark, SF_SMALL)) == 2
        for name in ("mart_cube", "mart_rollup", "mart_pivot"):
            assert boarding_grain_exchanges(R.QUERIES[name](spark, SF_SMALL)) <= 2
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
