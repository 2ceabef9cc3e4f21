"""The change feed, the warehouse stream with its marks, and tables kept in parts."""

import json

import pytest
from pyspark.sql import functions as F

from dimforge import publish as P
from dimforge.plans.warehouse import Warehouse
from dimforge.sources.tables import Tables
from dimforge.streaming import change_feed as C
from dimforge.streaming import warehouse_stream as WS

from .conftest import SF_SMALL


def line(source, action, seq, row, ts="2024-01-01T00:00:00.000000"):
    return json.dumps({"source": source, "action": action, "seq": seq, "change_ts": ts, "payload": json.dumps(row)})


def customer(k, **more):
    return {"c_custkey": k, "c_name": f"c{k}", "c_nationkey": 1, "c_acctbal": 1.5, "c_mktsegment": "A", **more}


def order(k, cust, day="2020-01-01", price=10.0):
    return {"o_orderkey": k, "o_custkey": cust, "o_orderstatus": "F", "o_totalprice": price,
            "o_orderdate": f"{day}T00:00:00.000000", "o_orderpriority": "1"}


def boarding(k, n, supp=1, day="2020-02-01"):
    return {"l_orderkey": k, "l_partkey": 1, "l_suppkey": supp, "l_linenumber": n, "l_quantity": 1.0, "l_extendedprice": 9.0,
            "l_discount": 0.1, "l_tax": 0.0, "l_returnflag": "N", "l_linestatus": "O", "l_shipdate": f"{day}T00:00:00.000000"}


def event(k, user, ts, kind="purchase", value=5.0):
    return {"event_id": k, "ts": f"{ts}T00:00:00.000000", "user_id": user, "event_type": kind, "value": value, "props": "{}"}


FIRST = [line("customer", "I", k, customer(k)) for k in range(1, 6)] + [
    line("supplier", "I", 1, {"s_suppkey": 1, "s_name": "s", "s_nationkey": 2, "s_acctbal": 0.0}),
    *(line("orders", "I", k, order(k, 1 + k % 5)) for k in range(1, 41)),
    *(line("lineitem", "I", k, boarding(k, 1)) for k in range(1, 41)),
    line("events", "I", 1, event(1, 2, "2024-01-02"))]


@pytest.fixture
def feed(spark):
    return WS.Feed.of(Tables(spark, SF_SMALL), part_keys=8)


def lines(spark, rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def table(spark, root, name):
    df = P.read_current(spark, root, name)
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_every_reason_and_the_counts(spark, tmp_path, feed):
    bad = ["", "no json", '{"source": "orders"', line("other", "I", 1, {}), line("orders", "Q", 1, order(1, 1)),
           line("orders", "I", None, order(1, 1)), line("orders", "I", 1, order(1, 1), ts=None),
           line("orders", "I", 1, order(1, 1, price="dear")), line("orders", "I", 1, {**order(1, 1), "o_orderkey": None}),
           json.dumps({"source": "orders", "action": "I", "seq": 1, "change_ts": "2024-01-01T00:00:00.000000"})]
    routed = C.route(lines(spark, [*bad, *FIRST]), feed.sources, str(tmp_path / "r"))
    assert routed.counts == {"n_read": len(bad) + len(FIRST), "n_loadable": len(FIRST), "n_rejected": len(bad)}
    got = {r["line"]: r["reason"] for r in routed.rejects().collect()}
    assert got == dict(zip(bad, ["not a feed line"] * 3 + ["unknown source", "unknown action"] + ["no sequence number or time"] * 2
                           + ["row doesn't fit the table", "no key", "row doesn't fit the table"], strict=True))
    assert routed.of("orders").count() == 40 and routed.of("customer").columns[:3] == ["_action", "_seq", "_change_ts"]


def test_a_run_finds_its_own_delta_and_a_failed_one_moves_no_mark(spark, tmp_path, feed, monkeypatch):
    root, landing = str(tmp_path / "t"), tmp_path / "landing"
    landing.mkdir()
    (landing / "1.txt").write_text("\n".join(FIRST) + "\nbroken\n")
    first = WS.apply_pending(spark, str(landing), root, feed)
    assert first == {"n_read": len(FIRST) + 1, "n_consumed": len(FIRST), "n_rejected": 1, "n_behind": 0}
    (landing / "1.txt").write_text("\n".join(FIRST) + "\n")
    (landing / "2.txt").write_text(line("orders", "I", 99, order(50, 3)) + "\n" + line("events", "I", 2, event(2, 2, "2024-01-05")))
    before = {n: table(spark, root, n) for n in ("marks", "trip_fact", "member_dim", "calendar", "log_orders")}

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(P.Run, "commit", fail)
        with pytest.raises(RuntimeError, match="lost"):
            WS.apply_pending(spark, str(landing), root, feed)
    assert {n: table(spark, root, n) for n in before} == before
    second = WS.apply_lines(spark, spark.read.text(str(landing)), root, feed, "b")
    assert second["n_consumed"] == 2 and second["n_behind"] == len(FIRST)
    version = P.current_version(spark, root, "marks")
    assert WS.apply_lines(spark, spark.read.text(str(landing)), root, feed, "b")["n_read"] == 0  # the same batch once more
    assert WS.apply_pending(spark, str(landing), root, feed)["n_consumed"] == 0
    assert P.current_version(spark, root, "marks") == version
    assert P.read_current(spark, root, "trip_fact").count() == 41
    assert [r["line"] for r in P.read_current(spark, root, "feed_rejects").collect()] == ["broken"]
    assert C.stored_marks(spark, root)["orders"][0] == 99


def test_updates_deletes_and_changed_members_reach_the_facts(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    WS.apply_lines(spark, lines(spark, [*FIRST, line("orders", "I", 200, order(80, 2, "2024-03-01"))]), root, feed, "a")
    old = {r["trip_id"]: r["member_key"] for r in P.read_current(spark, root, "trip_fact").collect()}
    WS.apply_lines(spark, lines(spark, [
        line("orders", "U", 201, order(7, 3, price=77.0)), line("lineitem", "D", 101, boarding(8, 1)),
        line("lineitem", "I", 102, boarding(9, 2)), line("orders", "D", 202, order(10, 1)),
        line("events", "I", 9, event(9, 2, "2024-02-01", "view")), line("events", "I", 10, event(10, 2, "2023-01-01"))]),
        root, feed, "b")
    trips = {r["trip_id"]: r for r in P.read_current(spark, root, "trip_fact").collect()}
    revenue = {r["order_id"]: r["count"] for r in P.read_current(spark, root, "revenue_fact").groupBy("order_id").count().collect()}
    assert set(trips) == set(old) - {10} and 10 not in revenue
    assert float(trips[7]["price"]) == 77.0 and trips[7]["origin_address_key"] == 3
    assert trips[8]["n_boardings"] == 0 and 8 not in revenue and revenue[9] == 2
    # the order after the member's change follows it; the change from before the current version is set aside
    assert {k for k in trips if old[k] != trips[k]["member_key"]} == {80}
    assert P.read_current(spark, root, "member_late").count() == 1


def files(root, name):
    return {str(p) for p in root.glob(f"{name}/*/*/*.parquet")}


def test_few_changed_keys_write_few_files(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(100_000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    run = P.Run(spark, root)
    run.replace_in_parts("f", rows, rows.select("k"), "k", 1000)  # 100 parts
    run.commit()
    before = files(tmp_path, "f")
    changed = spark.range(50_000, 51_000).select(F.col("id").alias("k"))  # 1 %
    run = P.Run(spark, root)
    run.replace_in_parts("f", changed.where("k % 2 = 0").select("k", F.lit(-1).cast("long").alias("v")), changed, "k", 1000)
    run.commit()
    new = files(tmp_path, "f") - before
    assert 0 < len(new) <= len(before) / 50 + 1
    got = P.read_current(spark, root, "f")
    assert got.count() == 99_500 and got.where("v = -1").count() == 500 and got.columns == ["k", "v"]


def test_parts_come_and_go(spark, tmp_path):
    root, schema = str(tmp_path), "k long, v string"
    run = P.Run(spark, root)
    run.replace_in_parts("f", spark.createDataFrame([(1, "a"), (25, "b"), (-3, "c")], schema),
                         spark.createDataFrame([], "k long"), "k", 10)
    run.commit()
    run = P.Run(spark, root)
    run.replace_in_parts("f", spark.createDataFrame([(31, "d")], schema), spark.createDataFrame([(25,), (-3,), (7,)], "k long"), "k", 10)
    run.commit()
    assert table(spark, root, "f") == [(1, "a"), (31, "d")]
    run = P.Run(spark, root)
    run.replace_in_parts("f", spark.createDataFrame([], schema), spark.createDataFrame([(1,), (31,)], "k long"), "k", 10)
    assert table(spark, root, "f") == [(1, "a"), (31, "d")]  # not committed yet
    run.commit()
    assert table(spark, root, "f") == []
    assert P.remove_uncommitted(spark, root, ["f"], keep_versions=1) > 0
    assert table(spark, root, "f") == []


def test_the_reason_of_a_line_is_worked_out_once(spark, feed):
    plan = C.parse(lines(spark, FIRST), feed.sources)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("not a feed line") == 1


def test_rows_behind_the_marks_are_counted_and_not_written(spark, tmp_path, feed):
    routed = C.route(lines(spark, [*FIRST, "broken"]), feed.sources, str(tmp_path / "r"), {"orders": 30, "lineitem": 40})
    assert routed.counts == {"n_read": len(FIRST) + 1, "n_loadable": len(FIRST), "n_rejected": 1}
    assert routed.of("orders").count() == 10 and routed.of("lineitem").count() == 0 and routed.of("customer").count() == 5
    assert routed.rejects().count() == 1 and not list((tmp_path / "r").glob("of_source=lineitem/*"))
    root = str(tmp_path / "t")
    for _ in range(2):
        WS.apply_lines(spark, lines(spark, FIRST), root, feed)
    assert len({p.parts[-3] for p in (tmp_path / "t" / "_routed").glob("*/of_source=*/*.parquet")}) == 1


def test_revenue_on_a_written_trip_fact_equals_that_from_the_sources(spark, tmp_path, feed):
    more = [line("lineitem", "I", 50, boarding(3, 1)), line("lineitem", "I", 51, boarding(4, 2, supp=None)),
            line("lineitem", "I", 52, boarding(99, 1)), line("orders", "I", 50, order(5, 2)), line("orders", "I", 51, order(6, None))]
    routed = C.route(lines(spark, [*FIRST, *more]), feed.sources, str(tmp_path / "r"))
    w = Warehouse.over(Tables.of(spark, {**feed.reference, **{n: routed.of(n) for n in feed.sources}}))
    got = sorted(map(tuple, w.revenue_fact_on(w.boardings, w.trip_fact).collect()), key=str)
    assert got == sorted(map(tuple, w.revenue_fact.collect()), key=str) and len(got) == 42  # orders 3 and 5 twice


def test_a_batch_leaves_no_scratch_and_old_versions_can_go(spark, tmp_path, feed):
    root = str(tmp_path / "t")
    for k, rows in enumerate(([*FIRST], [line("orders", "I", 300, order(81, 2)), line("events", "I", 90, event(90, 2, "2024-02-01"))])):
        WS.apply_lines(spark, lines(spark, rows), root, feed, str(k))
        assert not [p for n in ("affected_members", "fresh_members", "affected_trips", "fresh_trips", "fresh_revenue")
                    for p in (tmp_path / "t" / n).glob("**/*.parquet")]
    names = P.tables(spark, root)
    before = {n: sorted(map(str, P.read_current(spark, root, n).collect())) for n in names}
    assert {"trip_fact", "revenue_fact", "member_dim", "marks"} <= set(names) and len(before["trip_fact"]) > 1
    assert WS.remove_old(spark, root) > 0
    assert {n: sorted(map(str, P.read_current(spark, root, n).collect())) for n in names} == before
    assert not list((tmp_path / "t" / WS.ROUTED).glob("*")) and len(list((tmp_path / "t" / "marks").glob("*"))) == 1
    assert WS.apply_lines(spark, lines(spark, FIRST), root, feed)["n_consumed"] == 0
