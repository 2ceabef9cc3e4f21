"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each paired with
its DuckDB formulation in ``ORACLE`` where one exists.

Every query reads the given tables (or data Spark derives from them), whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.functions import keys as K
from dimforge.operators import calendar as cal
from dimforge.operators import cdc, digest
from dimforge.operators import incremental as inc
from dimforge.operators import quality as Q
from dimforge.operators.dedup import last_state_per_key, latest_per_key
from dimforge.operators.joins import validity_join, validity_merge
from dimforge.operators.scd import (Scd2Spec, scd1_overwrite, scd1_refresh_external, scd2_apply,
                                    scd2_close, scd2_history, scd2_initial, split_late_changes)
from dimforge.plans import feed_queries
from dimforge.plans import oracle as O
from dimforge.plans import standins as S
from dimforge.plans.lake import (SILVER_SCHEMA, build_address_dim, curated_lake, land, run_lake, silver_and_rejects,
                                 source_folder, staged_bronze, suggestion_penetration)
from dimforge.plans.queries_sql import SQL
from dimforge.plans.warehouse import Warehouse
from dimforge.session import work_dir
from dimforge.sources import ingest

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: bool = True):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = SQL[name]
        return fn
    return deco


def _address_dim(spark: SparkSession, w: Warehouse) -> DataFrame:
    """Gold address dimension on the curated population, built inside the
    query's plan (``curated_lake``; the file path is ``run_lake``)."""
    return build_address_dim(S.addresses(w.t), curated_lake(w.t).silver)


# ============================================================================ flagship
@register("mart_penetration")
def mart_penetration(spark, sf_dir):
    """V6: boardings, revenue and suggestions per place, rates per 100k."""
    w = Warehouse(spark, sf_dir)
    return w.penetration(_address_dim(spark, w))


# ============================================================================ keys, lake
@register("place_key")
def place_key(spark, sf_dir):
    """L2 over whole documents: normalised text key of each text and language."""
    w = Warehouse(spark, sf_dir)
    key = K.place_key(F.col("text"), F.col("lang"))
    return w.t.documents.select("doc_id", "lang", F.md5(key).alias("key_md5"),
                                F.length(key).alias("key_length"))


@register("size_band")
def size_band(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    s = curated_lake(w.t).silver
    return s.select("code", "place_name", "region", "population", K.size_band("population").alias("size_band"))


@register("bronze_append_once")
def bronze_append_once(spark, sf_dir):
    """v1 ingested twice (second a no-op), then v2."""
    w = Warehouse(spark, sf_dir)
    return run_lake(spark, w.t).bronze


@register("bronze_by_content")
def bronze_by_content(spark, sf_dir):
    """S3 by content: suppliers land in two files, the first of them twice under other names; three loads."""
    t = Warehouse(spark, sf_dir).t
    at = work_dir(spark, "by-content")
    rows = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
    for name, part in (("a", rows.filter("s_nationkey < 13")), ("copy", rows.filter("s_nationkey < 13")),
                       ("other", rows.filter("s_nationkey >= 13"))):
        land(part, f"{at}/landing/{name}")
        raw = ingest.read_raw_csv(spark, f"{at}/landing/*", rows.columns)
        ingest.append_new_contents(spark, raw.select("*", source_folder().alias("_source_file")), f"{at}/bronze", f"{at}/manifest")
    return spark.read.parquet(f"{at}/bronze").select(*rows.columns, "_source_file")


@register("lake_silver")
def lake_silver(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return run_lake(spark, w.t).silver


@register("silver_latest")
def silver_latest(spark, sf_dir):
    """Latest event per user, cleaned and typed."""
    w = Warehouse(spark, sf_dir)
    e = w.t.events
    latest = latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])
    return latest.select("user_id", F.upper(F.trim("event_type")).alias("last_event_type"),
                         K.money("value").alias("last_value"), F.col("ts").alias("last_ts"),
                         F.regexp_replace("props", "[^0-9]", "").try_cast("bigint").alias("props_number"))


@register("enrich_left_join")
def enrich_left_join(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return _address_dim(spark, w)


@register("enrich_check")
def enrich_check(spark, sf_dir):
    """Q11/Q14/Q2: enrichment keeps every address once; silver key unique."""
    w = Warehouse(spark, sf_dir)
    lake = run_lake(spark, w.t)
    addr = S.addresses(w.t)
    dim = build_address_dim(addr, lake.silver)
    dup = Q.duplicate_keys(lake.silver, ["place_key"])
    no_pop = dim.filter(F.col("population").isNull())
    return Q.counts({"addresses_in": addr, "addresses_out": dim, "silver_duplicate_keys": dup,
                     "addresses_without_population": no_pop})


@register("dataset_catalogue")
def dataset_catalogue(spark, sf_dir):
    """Register every given table with its row count."""
    w = Warehouse(spark, sf_dir)
    cat = spark.createDataFrame([], "dataset string, source_file string, last_import timestamp_ntz, row_count bigint")
    from dimforge.sources.tables import TABLES
    for name in TABLES:
        cat = ingest.catalogue_upsert(cat, name, getattr(w.t, name), f"{name}.parquet", S.ts(S.CATALOGUE_AT))
    return cat


@register("gold_dim_refresh")
def gold_dim_refresh(spark, sf_dir):
    """Place population before and after the republication."""
    w = Warehouse(spark, sf_dir)
    lake = curated_lake(w.t)
    addr = S.addresses(w.t)
    before = build_address_dim(addr, lake.silver_v1).groupBy("place_name", "region").agg(
        F.max("population").alias("population_before"))
    after = build_address_dim(addr, lake.silver).groupBy("place_name", "region").agg(
        F.max("population").alias("population_after"))
    j = before.join(after, ["place_name", "region"])
    return j.withColumn("changed", ~F.col("population_before").eqNullSafe(F.col("population_after")))


@register("scd1_external")
def scd1_external(spark, sf_dir):
    """Refresh external attributes on every address of a place,
    rewriting only rows whose values differ."""
    w = Warehouse(spark, sf_dir)
    lake = curated_lake(w.t)
    dim_v1 = build_address_dim(S.addresses(w.t), lake.silver_v1)
    return scd1_refresh_external(
        dim_v1, lake.silver, K.place_key(F.col("place_name"), F.col("region")), "place_key",
        {"place_code": "code", "population": "population", "population_year": "ref_year"},
        derived={"size_band": K.size_band("population")})


@register("gold_penetration")
def gold_penetration(spark, sf_dir):
    """Suggestions per 100k inhabitants from the gold address dim."""
    w = Warehouse(spark, sf_dir)
    dim = _address_dim(spark, w)
    sugg = w.t.events.select(F.col("event_id").alias("suggestion_id"), F.col("user_id").alias("address_id"))
    return suggestion_penetration(dim, sugg)


@register("key_consistency")
def key_consistency(spark, sf_dir):
    """Stored key vs key recomputed from the cleaned columns."""
    w = Warehouse(spark, sf_dir)
    s = curated_lake(w.t).silver
    re = K.place_key(F.col("place_name"), F.col("region"))
    return s.filter(~F.col("place_key").eqNullSafe(re)).select("code", "place_name", "place_key",
                                                                 re.alias("recomputed_key"))


@register("typed_refresh")
def typed_refresh(spark, sf_dir):
    """Export silver, re-import it with an explicit schema
    (FAILFAST), full refresh of the curated table."""
    w = Warehouse(spark, sf_dir)
    lake = curated_lake(w.t)
    root = work_dir(spark, "typed-refresh")
    export = f"{root}/export/silver_csv"
    ingest.export_sorted_csv(lake.silver, export, ["code"])
    curated = f"{root}/curated/population"
    ingest.overwrite(ingest.read_typed_csv(spark, export, SILVER_SCHEMA), curated)
    return spark.read.parquet(curated)


@register("sorted_export")
def sorted_export(spark, sf_dir):
    """Globally sorted CSV export (range-partitioned sort, no single
    task), read back with its schema."""
    w = Warehouse(spark, sf_dir)
    lake = curated_lake(w.t)
    root = work_dir(spark, "sorted-export")
    export = f"{root}/export/sorted"
    ingest.export_sorted_csv(lake.silver.select("code", "place_name", "population"), export, ["code"])
    return ingest.read_typed_csv(spark, export, "code string, place_name string, population bigint")


# ============================================================================ calendar
@register("calendar_dim")
def calendar_dim(spark, sf_dir):
    return Warehouse(spark, sf_dir).calendar


@register("calendar_unseen")
def calendar_unseen(spark, sf_dir):
    """Dates of the event feed not yet in a calendar built from
    orders and lineitem."""
    w = Warehouse(spark, sf_dir)
    stored = cal.calendar_rows(cal.seen_dates([(w.t.orders, "o_orderdate"), (w.t.lineitem, "l_shipdate")]))
    e = w.t.events
    new = cal.seen_dates([(e, "ts"), (e.select(w.planned_ts(e).alias("planned")), "planned")])
    return cal.unseen_calendar_rows(new, stored)


# ============================================================================ SCD2
@register("scd2_initial")
def scd2_initial_q(spark, sf_dir):
    return Warehouse(spark, sf_dir).member_initial


@register("scd2_apply")
def scd2_apply_q(spark, sf_dir):
    """The whole feed as one batch (last state per member)."""
    w = Warehouse(spark, sf_dir)
    return scd2_apply(w.member_initial, S.member_changes(w.t), S.MEMBER, "change_ts", "seq")


@register("scd2_history")
def scd2_history_q(spark, sf_dir):
    """Daily batches applied in order, in one pass."""
    return Warehouse(spark, sf_dir).member_dim


@register("scd2_close")
def scd2_close_q(spark, sf_dir):
    """Versions appended without closing get closed by ``lead``."""
    w = Warehouse(spark, sf_dir)
    open_all = w.member_dim.withColumn("valid_to", F.lit(None).cast("date")).withColumn("is_current", F.lit("Y"))
    return scd2_close(open_all, S.MEMBER)


@register("scd2_type1_overwrite")
def scd2_type1_overwrite(spark, sf_dir):
    """Names corrected in the source overwrite every version of the
    members present in the change feed; no version is created."""
    w = Warehouse(spark, sf_dir)
    fixed = w.t.customer.select(F.col("c_custkey").alias("member_id"),
                                F.concat("c_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("member_name"),
                                F.col("c_nationkey").alias("place_id"))
    keys = w.t.events.select(F.col("user_id").alias("member_id"))
    return scd1_overwrite(w.member_dim, fixed, "member_id", ("member_name", "place_id"), keys)


@register("current_members")
def current_members(spark, sf_dir):
    return Warehouse(spark, sf_dir).member_dim.filter(F.col("is_current") == "Y")


@register("validity_join")
def validity_join_q(spark, sf_dir):
    """Each purchase gets the member version in force on its date."""
    w = Warehouse(spark, sf_dir)
    p = w.t.events.filter(F.col("event_type") == "purchase")
    j = validity_join(p, w.member_dim, "user_id", F.col("ts").cast("date"), "member_id")
    return j.select("event_id", F.col("user_id").alias("member_id"), F.col("ts").cast("date").alias("paid_on"),
                    F.col("v_version").alias("member_version"), F.col("v_segment").alias("segment_then"),
                    F.col("v_balance").alias("balance_then"))


@register("validity_merge")
def validity_merge_q(spark, sf_dir):
    """J2 for long histories: the rows of ``validity_join`` from one sorted stream of purchases and versions."""
    w = Warehouse(spark, sf_dir)
    p = w.t.events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    m = w.member_dim.select("member_id", "version", "segment", "balance", "valid_from", "valid_to")
    j = validity_merge(p, m, "user_id", F.col("ts").cast("date"), "member_id")
    return j.select("event_id", F.col("user_id").alias("member_id"), F.col("ts").cast("date").alias("paid_on"),
                    F.col("v_version").alias("member_version"), F.col("v_segment").alias("segment_then"),
                    F.col("v_balance").alias("balance_then"))


@register("payment_version_listing")
def payment_version_listing(spark, sf_dir):
    """Q10: every member payment with the version (and balance) it hit."""
    w = Warehouse(spark, sf_dir)
    f = w.expense_fact.filter(F.col("expense_type") == "Member payment")
    m = w.member_dim.select(F.col("sk").alias("member_key"), "member_id", "member_name", "version", "balance")
    c = w.calendar.select("calendar_key", "full_date")
    return (f.join(m, "member_key").join(c, "calendar_key")
            .select("source_id", F.col("full_date").alias("paid_on"), "net_amount", "member_id", "member_name",
                    F.col("version").alias("member_version"), F.col("balance").alias("balance_then"))
            .orderBy("member_id", "paid_on", "source_id"))


@register("dq_scd2_summary")
def dq_scd2_summary(spark, sf_dir):
    """Q6/Q7/Q8/Q19/Q20 on the member dimension: violations per check."""
    d = Warehouse(spark, sf_dir).member_dim
    return Q.counts({"multiple_current": Q.multiple_current(d, "member_id"),
                     "current_flag_inconsistent": Q.current_flag_inconsistent(d, "member_id"),
                     "overlapping_validity": Q.overlapping_validity(d, "member_id"),
                     "end_before_start": Q.end_before_start(d),
                     "duplicate_version": Q.duplicate_keys(d, ["member_id", "version"])})


@register("overlap_pairs")
def overlap_pairs(spark, sf_dir):
    return Q.overlapping_validity(Warehouse(spark, sf_dir).member_dim, "member_id")


@register("dq_versions_per_key")
def dq_versions_per_key(spark, sf_dir):
    return Q.versions_per_key(Warehouse(spark, sf_dir).member_dim, "member_id")


# ============================================================================ facts
@register("fact_revenue")
def fact_revenue(spark, sf_dir):
    return Warehouse(spark, sf_dir).revenue_fact


@register("fact_trip_snapshot")
def fact_trip_snapshot(spark, sf_dir):
    return Warehouse(spark, sf_dir).trip_fact


@register("fact_expense")
def fact_expense(spark, sf_dir):
    return Warehouse(spark, sf_dir).expense_fact


@register("fact_factless")
def fact_factless(spark, sf_dir):
    return Warehouse(spark, sf_dir).suggestion_fact


@register("status_rule")
def status_rule(spark, sf_dir):
    """trips per derived status."""
    t = Warehouse(spark, sf_dir).trips
    return t.groupBy("trip_status").agg(F.count(F.lit(1)).alias("n_trips"))



@register("coalesce_nullif_rates")
def coalesce_nullif_rates(spark, sf_dir):
    """Per place, coalesce defaults and rates per 100k with a
    zero-population guard."""
    return Warehouse(spark, sf_dir).place_rates()

def _split(w: Warehouse):
    e_old = w.t.events.filter(F.col("ts") < S.ts(S.EVENTS_CUT))
    e_new = w.t.events.filter(F.col("ts") >= S.ts(S.EVENTS_CUT))
    o_old = w.t.orders.filter(F.col("o_orderdate") < S.ts(S.ORDERS_CUT))
    o_new = w.t.orders.filter(F.col("o_orderdate") >= S.ts(S.ORDERS_CUT))
    return e_old, e_new, o_old, o_new


@register("fact_expense_delta")
def fact_expense_delta(spark, sf_dir):
    """mode 1 — only new source rows, idempotent on the fact key."""
    w = Warehouse(spark, sf_dir)
    e_old, e_new, o_old, o_new = _split(w)
    stored = w.expense_fact_for(e_old, o_old)
    return inc.append_new(stored, w.expense_fact_for(e_new, o_new), ["source_id", "expense_type"])


@register("fact_except_delta")
def fact_except_delta(spark, sf_dir):
    """Mode 2 — recompute everything and EXCEPT the stored fact."""
    w = Warehouse(spark, sf_dir)
    e_old, _, o_old, _ = _split(w)
    return inc.except_delta(w.expense_fact, w.expense_fact_for(e_old, o_old))


@register("fact_revenue_delta")
def fact_revenue_delta(spark, sf_dir):
    """F8: boardings of new trips; status from all notices known at load."""
    w = Warehouse(spark, sf_dir)
    _, _, o_old, o_new = _split(w)
    old_b = w.boardings.join(o_old.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    new_b = w.boardings.join(o_new.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi")
    stored = w.revenue_fact_for(old_b, w.trips)
    return inc.append_new(stored, w.revenue_fact_for(new_b, w.trips), ["order_id", "line_no"])


@register("fact_factless_delta")
def fact_factless_delta(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    e_old, e_new, _, _ = _split(w)
    return inc.append_new(w.suggestion_fact_for(e_old), w.suggestion_fact_for(e_new), ["suggestion_id"])


@register("trip_replace_by_key")
def trip_replace_by_key(spark, sf_dir):
    """the trip snapshot stored at the cut is refreshed by key — trips
    with boardings / notices since the day before the cut, and new trips,
    are rebuilt from the sources; the result equals a full rebuild."""
    w = Warehouse(spark, sf_dir)
    cut = S.ts(S.ORDERS_CUT)
    o_old = w.t.orders.filter(F.col("o_orderdate") < cut)
    b_old = w.boardings.filter(F.col("l_shipdate") < cut)
    stored = w.trip_fact_for(w.trips_for(o_old, b_old))
    since = cut - F.expr("INTERVAL 1 DAY")
    recent = w.boardings.filter(F.col("l_shipdate") > since).select(F.col("l_orderkey").alias("trip_id"))
    new_trips = w.t.orders.filter(F.col("o_orderdate") >= cut).select(F.col("o_orderkey").alias("trip_id"))
    affected = recent.unionByName(new_trips)
    rebuilt, _ = w.trip_facts_for_keys(affected, "trip_id")
    return inc.replace_by_key(stored, rebuilt, ["trip_id"], affected)


# ============================================================================ CDC
def _member_state(w: Warehouse, as_of: str | None) -> DataFrame:
    c = S.member_changes(w.t)
    if as_of is not None:
        c = c.filter(F.col("change_ts") < S.ts(as_of))
    last = last_state_per_key(c, ["member_id"], ["change_ts", "seq"], ["segment", "balance"])
    return last.filter(F.col("segment") != S.CLOSED_SEGMENT)


def _diff(w: Warehouse) -> DataFrame:
    return cdc.snapshot_diff(_member_state(w, S.SNAPSHOT_OLD_AS_OF), _member_state(w, None), ["member_id"])


@register("snapshot_diff")
def snapshot_diff(spark, sf_dir):
    """K1: inserts, updates and deletes between two member snapshots."""
    d = _diff(Warehouse(spark, sf_dir))
    return d.select("member_id", "action", F.col("old.segment").alias("old_segment"),
                    F.col("old.balance").alias("old_balance"), F.col("new.segment").alias("new_segment"),
                    F.col("new.balance").alias("new_balance"))


@register("audit_log")
def audit_log(spark, sf_dir):
    """Generic change log with JSON row images."""
    d = _diff(Warehouse(spark, sf_dir))
    return cdc.audit_log(d, "source", "member", S.ts(S.CATALOGUE_AT))


@register("typed_deltas")
def typed_deltas(spark, sf_dir):
    """K2/K3: typed insert and update mirrors (updates carry change time)."""
    d = _diff(Warehouse(spark, sf_dir))
    ins = cdc.typed_delta(d, "I").withColumn("action", F.lit("I")).withColumn(
        "change_ts", F.lit(None).cast("timestamp_ntz"))
    upd = cdc.typed_delta(d, "U", S.ts(S.CATALOGUE_AT)).withColumn("action", F.lit("U"))
    return ins.unionByName(upd)


@register("quarantine_counts")
def quarantine_counts(spark, sf_dir):
    """K4: malformed change rows are set aside and counted, never lost."""
    e = Warehouse(spark, sf_dir).t.events
    k = F.get_json_object("props", "$.k")
    valid = F.col("value").isNotNull() & (F.col("value") >= 0) & k.isNotNull() & F.col("ts").isNotNull()
    ok, bad = cdc.split_quarantine(e, valid, F.lit("malformed"))
    both = (ok.select("event_type", F.lit(True).alias("ok"))
            .unionByName(bad.select("event_type", F.lit(False).alias("ok"))))
    return both.groupBy("event_type").agg(F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok")).alias("n_quarantined"))


@register("incremental_stream")
def incremental_stream(spark, sf_dir):
    """Change files land in two rounds; each run of the file stream
    (availableNow) applies only unprocessed files via foreachBatch and
    publishes a new dimension version.  The end state equals the one-pass
    history."""
    from dimforge import publish as P
    from dimforge.streaming.member_feed import apply_feed_once
    w = Warehouse(spark, sf_dir)
    root = work_dir(spark, "stream")
    landing, ckpt, tables = f"{root}/landing", f"{root}/checkpoint", f"{root}/tables"
    P.publish(spark, w.member_initial, tables, "member_dim")
    changes = S.member_changes(w.t)
    cut = S.ts(S.EVENTS_CUT)
    changes.filter(F.col("change_ts") < cut).write.mode("append").parquet(landing)
    apply_feed_once(spark, landing, ckpt, tables, "member_dim", S.MEMBER, "change_ts", "seq", changes.schema)
    changes.filter(F.col("change_ts") >= cut).write.mode("append").parquet(landing)
    apply_feed_once(spark, landing, ckpt, tables, "member_dim", S.MEMBER, "change_ts", "seq", changes.schema)
    return P.read_current(spark, tables, "member_dim")


# ============================================================================ dims
@register("dim_customer")
def dim_customer(spark, sf_dir):
    return Warehouse(spark, sf_dir).customer_dim


@register("dim_supplier")
def dim_supplier(spark, sf_dir):
    return Warehouse(spark, sf_dir).supplier_dim


@register("dim_place")
def dim_place(spark, sf_dir):
    return Warehouse(spark, sf_dir).place_dim


@register("dims_insert_only")
def dims_insert_only(spark, sf_dir):
    """Batch 1 = customers with an order before the cut; batch 2
    re-delivers every customer; only unseen ids are inserted."""
    w = Warehouse(spark, sf_dir)
    d = w.customer_dim
    early = w.t.orders.filter(F.col("o_orderdate") < S.ts(S.ORDERS_CUT)).select(
        F.col("o_custkey").alias("customer_id"))
    batch1 = d.join(early, "customer_id", "left_semi")
    return batch1.unionByName(inc.append_new(batch1, d, ["customer_id"]))


# ============================================================================ marts
@register("mart_revenue")
def mart_revenue(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    return w.revenue_mart(_address_dim(spark, w))


@register("mart_expense")
def mart_expense(spark, sf_dir):
    """V2: expenses with calendar (inner) and member / customer (left)."""
    w = Warehouse(spark, sf_dir)
    c = w.calendar.select("calendar_key", "year", "full_date", "month", "quarter")
    m = w.member_dim.select(F.col("sk").alias("member_key"), "member_name", F.col("segment").alias("member_segment"),
                            F.col("balance").alias("member_balance"), F.col("version").alias("member_version"),
                            F.col("is_current").alias("member_current"))
    cu = w.customer_dim.select("customer_key", "customer_name", F.col("segment").alias("customer_segment"))
    j = w.expense_fact.join(c, "calendar_key").join(m, "member_key", "left").join(cu, "customer_key", "left")
    return j.select("source_id", "expense_type", "description", "amount", "net_amount", "tax_amount",
                    "year", "full_date", "month", "quarter", "member_name", "member_segment", "member_balance",
                    "member_version", "member_current", "customer_name", "customer_segment")


@register("mart_trip")
def mart_trip(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    c = w.calendar.select(F.col("calendar_key").alias("start_calendar_key"), "year", "full_date")
    m = w.member_dim.select(F.col("sk").alias("member_key"), "member_name", F.col("version").alias("member_version"))
    j = w.trip_fact.join(c, "start_calendar_key").join(m, "member_key")
    return j.select("trip_id", "start_ts", "end_ts", "trip_status", "n_boardings", "revenue", "duration_min",
                    "n_delay", "n_cancel", "year", "full_date", "member_name", "member_version")


@register("mart_suggestion")
def mart_suggestion(spark, sf_dir):
    w = Warehouse(spark, sf_dir)
    a = _address_dim(spark, w)
    c = w.calendar.select(F.col("calendar_key").alias("planned_calendar_key"), "year", "full_date")
    cu = w.customer_dim.select("customer_key", "customer_name")
    ad = a.select("address_key", "place_name", "region", "place_code", "population", "size_band")
    j = w.suggestion_fact.join(c, "planned_calendar_key").join(cu, "customer_key").join(ad, "address_key")
    return j.select("suggestion_id", "kind", "planned_ts", "year", "full_date", "customer_name", "place_name",
                    "region", "place_code", "population", "size_band")


@register("mart_cube")
def mart_cube(spark, sf_dir):
    """Revenue cube over year x trip status (all grouping sets)."""
    w = Warehouse(spark, sf_dir)
    return (w.revenue_by_day("year").cube("year", "trip_status")
            .agg(F.sum("boardings").alias("boardings"), F.sum("paid").cast("decimal(38,2)").alias("revenue"),
                 F.grouping_id().cast("int").alias("grouping_level")))


@register("mart_pivot")
def mart_pivot(spark, sf_dir):
    """Revenue by year with one column per trip status."""
    w = Warehouse(spark, sf_dir)
    f = w.revenue_by_day("year")
    statuses = [K.STATUS_CANCELLED, K.STATUS_LATE, K.STATUS_DONE, K.STATUS_RUNNING]
    p = f.groupBy("year").pivot("trip_status", statuses).agg(F.sum("paid"))
    return p.select("year", *[F.coalesce(F.col(s), F.lit(0)).cast("decimal(38,2)")
                              .alias(s.lower().replace(" ", "_")) for s in statuses])


# ============================================================================ quality
@register("dq_pk")
def dq_pk(spark, sf_dir):
    """Q16: primary-key uniqueness of boardings (order, line)."""
    t = Warehouse(spark, sf_dir).t
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@register("dq_fk_orphans")
def dq_fk_orphans(spark, sf_dir):
    """Q17: orphans per relation (child -> parent)."""
    w = Warehouse(spark, sf_dir)
    t = w.t
    return Q.counts({
        "orders.customer": Q.orphans(t.orders, "o_custkey", t.customer, "c_custkey"),
        "lineitem.orders": Q.orphans(t.lineitem, "l_orderkey", t.orders, "o_orderkey"),
        "lineitem.supplier": Q.orphans(t.lineitem, "l_suppkey", t.supplier, "s_suppkey"),
        "lineitem.part": Q.orphans(t.lineitem, "l_partkey", t.part, "p_partkey"),
        "events.customer": Q.orphans(t.events, "user_id", t.customer, "c_custkey"),
        "customer.nation": Q.orphans(t.customer, "c_nationkey", t.nation, "n_nationkey"),
        "fact_trip.member": Q.orphans(w.trip_fact, "member_key", w.member_dim, "sk"),
    })


@register("dq_domain")
def dq_domain(spark, sf_dir):
    """Q18: coded columns within their domains."""
    w = Warehouse(spark, sf_dir)
    t = w.t
    return Q.counts({
        "lineitem.l_returnflag": Q.domain_violations(t.lineitem, "l_returnflag", ["A", "N", "R"]),
        "lineitem.l_linestatus": Q.domain_violations(t.lineitem, "l_linestatus", ["O", "F"]),
        "orders.o_orderstatus": Q.domain_violations(t.orders, "o_orderstatus", ["F", "O", "P"]),
        "member.is_current": Q.domain_violations(w.member_dim, "is_current", ["Y", "N"]),
    })


@register("dq_counts")
def dq_counts(spark, sf_dir):
    """Q1/Q3/Q9: sources vs loaded facts (the validity join neither drops
    nor duplicates payments)."""
    w = Warehouse(spark, sf_dir)
    return Q.counts({
        "source_purchases": w.t.events.filter(F.col("event_type") == "purchase"),
        "fact_member_payments": w.expense_fact.filter(F.col("expense_type") == "Member payment"),
        "source_boardings": w.t.lineitem, "fact_revenue": w.revenue_fact,
        "source_trips": w.t.orders, "fact_trip": w.trip_fact,
        "fact_expense": w.expense_fact, "fact_suggestion": w.suggestion_fact,
    })


@register("reconcile_except")
def reconcile_except(spark, sf_dir):
    """Boardings in the source missing from the revenue fact."""
    w = Warehouse(spark, sf_dir)
    src = w.boardings.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), "paid")
    return Q.missing_from(src, w.revenue_fact.select("order_id", "line_no", "paid"))


@register("digest_differences")
def digest_differences(spark, sf_dir):
    """Q4/Q14/U4: boardings against a copy that lost, changed and repeated some rows, found by bucket checksums."""
    rows = Warehouse(spark, sf_dir).boardings.select(F.col("l_orderkey").alias("order_id"),
                                                     F.col("l_linenumber").alias("line_no"), "paid")
    copy = (rows.where(F.col("order_id") % 97 != 0)
            .withColumn("paid", F.when(F.col("order_id") % 89 == 0, F.col("paid") + 1).otherwise(F.col("paid"))
                        .cast("decimal(18,2)"))
            .withColumn("again", F.explode(F.sequence(F.lit(0), F.when(F.col("order_id") % 83 == 0, 1).otherwise(0))))
            .drop("again"))
    return digest.differences(rows, copy, ["order_id", "line_no"])


@register("dq_one_population_per_place")
def dq_one_population_per_place(spark, sf_dir):
    """Q13/A4: every address of a place carries the same population."""
    w = Warehouse(spark, sf_dir)
    a = _address_dim(spark, w)
    return a.groupBy("place_name", "region").agg(F.count(F.lit(1)).alias("n_addresses"),
                                                 F.countDistinct("population").alias("n_populations"))


@register("dq_role_rule")
def dq_role_rule(spark, sf_dir):
    """Q21: a trip's member must not have been closed at the trip start
    (point-in-time check through the validity join)."""
    w = Warehouse(spark, sf_dir)
    j = validity_join(w.trips, w.member_dim, "o_custkey", F.col("o_orderdate").cast("date"), "member_id")
    return j.filter(F.col("v_segment") == S.CLOSED_SEGMENT).select(
        F.col("o_orderkey").alias("trip_id"), F.col("o_custkey").alias("member_id"), "v_version")


@register("dq_has_child")
def dq_has_child(spark, sf_dir):
    """Q22: customers without any order."""
    t = Warehouse(spark, sf_dir).t
    return t.customer.select("c_custkey").join(
        t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


# ============================================================================ round-1 additions
@register("bronze_stream")
def bronze_stream(spark, sf_dir):
    """S3 streaming twin: a checkpointed file stream (availableNow) appends
    only newly landed folders; v1 landed twice is ingested once."""
    from dimforge.streaming.bronze import ingest_landing_once
    w = Warehouse(spark, sf_dir)
    root = work_dir(spark, "bronze-stream")
    bronze, ckpt = f"{root}/bronze", f"{root}/checkpoint"
    v1 = S.population_v1(w.t)
    cols = v1.columns
    land(v1, f"{root}/landing/population_v1")
    ingest_landing_once(spark, f"{root}/landing/*/", cols, bronze, ckpt, S.ts(S.LOAD_V1_AT))
    ingest_landing_once(spark, f"{root}/landing/*/", cols, bronze, ckpt, S.ts(S.LOAD_V1_AT))  # nothing new
    land(S.population_v2(w.t), f"{root}/landing/population_v2")
    ingest_landing_once(spark, f"{root}/landing/*/", cols, bronze, ckpt, S.ts(S.LOAD_V2_AT))
    return spark.read.parquet(bronze)


DOCUMENT = Scd2Spec(namespace="document", key="doc_id",
                    type1=("source", "language", "quality", "toxic"), type2=())
# Language codes and their labels.
LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish", "pt": "Portuguese"}


@register("dim_subtype_left")
def dim_subtype_left(spark, sf_dir):
    """Initial type-2 load of a document dimension, decoding the
    language and taking optional attributes from the 1:1 ``labels``
    subtype with a left join (documents without labels keep NULLs)."""
    t = Warehouse(spark, sf_dir).t
    src = (t.documents.select("doc_id", "source", "lang")
           .join(t.labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
           .select("doc_id", "source", K.decode("lang", LANGUAGES, "Other").alias("language"),
                   "quality", "toxic"))
    return scd2_initial(src, DOCUMENT)


@register("mart_rollup")
def mart_rollup(spark, sf_dir):
    """Revenue rolled up year > quarter > month, with subtotals."""
    w = Warehouse(spark, sf_dir)
    return (w.revenue_by_day("year", "quarter", "month").rollup("year", "quarter", "month")
            .agg(F.sum("boardings").alias("boardings"), F.sum("paid").cast("decimal(38,2)").alias("revenue"),
                 F.grouping_id().cast("int").alias("grouping_level")))


@register("listing_desc")
def listing_desc(spark, sf_dir):
    """O2: places by suggestions per 100k, highest first (presentation sort)."""
    w = Warehouse(spark, sf_dir)
    p = w.penetration(_address_dim(spark, w))
    return p.orderBy(F.col("suggestions_per_100k").desc_nulls_last(), "place_name", "region")


@register("first_value_lookup")
def first_value_lookup(spark, sf_dir):
    """O3/Q15: single-row lookup — the first place by code, its population
    before and after the republication (a top-1, not a collect)."""
    w = Warehouse(spark, sf_dir)
    lake = run_lake(spark, w.t)
    before = lake.silver_v1.select("code", F.col("population").alias("population_before"))
    after = lake.silver.select("code", "place_name", F.col("population").alias("population_after"))
    j = after.join(before, "code", "left")
    return j.orderBy("code").limit(1).select(
        "code", "place_name", "population_before", "population_after",
        (~F.col("population_before").eqNullSafe(F.col("population_after"))).alias("changed"))


@register("dq_pk_summary")
def dq_pk_summary(spark, sf_dir):
    """Q16 on every table: duplicate and NULL primary keys."""
    w = Warehouse(spark, sf_dir)
    t = w.t
    pks = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
           "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
           "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
           "labels": ["doc_id"], "benchmark": ["item_id"], "pages": ["page_id"],
           "conversations": ["conv_id", "turn"], "embeddings": ["vec_id"]}
    tables = Q.key_summary({name: (getattr(t, name).select(*keys), keys) for name, keys in pks.items()})
    return tables.unionByName(Q.counts({
        "member_dim.duplicate_keys": Q.duplicate_keys(w.member_dim, ["member_id", "version"]),
        "calendar.duplicate_keys": Q.duplicate_keys(w.calendar, ["calendar_key"])}))


@register("late_change_quarantine")
def late_change_quarantine(spark, sf_dir):
    """The dimension was loaded up to the cut; the feed then re-delivers
    the three days before it.  Changes dated before their member's current
    version start go to quarantine instead of corrupting history."""
    w = Warehouse(spark, sf_dir)
    cut = S.ts(S.EVENTS_CUT)
    ch = S.member_changes(w.t)
    dim = scd2_history(w.member_initial, ch.filter(F.col("change_ts") < cut), S.MEMBER,
                       "change_ts", "seq", F.to_date("change_ts"))
    redelivered = ch.filter(F.col("change_ts") >= cut - F.expr("INTERVAL 3 DAYS"))
    _, late = split_late_changes(dim, redelivered, S.MEMBER, "change_ts")
    return late.select("member_id", "change_ts", "seq", "current_from")


@register("full_load_publish")
def full_load_publish(spark, sf_dir):
    """Section 3.1 order: dimensions, then facts reading the *published*
    dimensions; returns each table's committed version and row count."""
    from dimforge import publish as P
    from dimforge.plans import load as L
    w = Warehouse(spark, sf_dir)
    root = work_dir(spark, "warehouse")
    versions = L.full_load(spark, w, _address_dim(spark, w), root)
    return Q.counts({f"{n}.v{v}": P.read_current(spark, root, n) for n, v in versions.items()})


@register("incremental_equals_full")
def incremental_equals_full(spark, sf_dir):
    """Section 3.2: publish the warehouse as of the cut, run the incremental
    load on the changes since, and compare every table with a full rebuild
    (extra / missing must be 0)."""
    from dimforge import publish as P
    from dimforge.plans import load as L
    root = work_dir(spark, "warehouse")
    w_cut = L.state_at_cut(spark, sf_dir)
    L.full_load(spark, w_cut, _address_dim(spark, w_cut), root)
    L.incremental(spark, sf_dir, root)
    fresh = Warehouse(spark, sf_dir)
    out = None
    for n in (*L.DIMS, "address_dim", *L.FACTS):
        rebuilt = _address_dim(spark, fresh) if n == "address_dim" else getattr(fresh, n)
        part = L.compare(n, P.read_current(spark, root, n), rebuilt)
        out = part if out is None else out.unionByName(part)
    return out


# ============================================================================ damaged inputs, so that checks find something
@register("silver_rejects")
def silver_rejects(spark, sf_dir):
    """Populations beyond 32 bits stay; those without digits or
    beyond 64 bits go to the rejects with a reason, none is lost."""
    w = Warehouse(spark, sf_dir)
    n = F.substring("code", 2, 10).cast("int")
    damaged = staged_bronze(w.t).withColumn(
        "population", F.when(n % 3 == 0, "n/a").when(n % 5 == 0, "9" * 25)
        .otherwise(F.concat(F.lit("6,000,"), "population")))
    good, bad = silver_and_rejects(damaged)
    return (good.select("code", "population", F.lit(None).cast("string").alias("reject_reason"))
            .unionByName(bad.select("code", F.lit(None).cast("bigint").alias("population"), "reject_reason")))


def _damaged_members(w: Warehouse) -> DataFrame:
    """Some first versions reopened and current again, some that end before they start, some rows twice."""
    d, first, m = w.member_dim, F.col("version") == 1, F.col("member_id")
    d = d.withColumn("is_current", F.when(first & (m % 7 == 0), "Y").otherwise(F.col("is_current"))).withColumn(
        "valid_to", F.when(first & (m % 7 == 0), F.lit(None).cast("date"))
        .when(first & (m % 11 == 0), F.date_sub("valid_from", 1)).otherwise(F.col("valid_to")))
    return d.unionByName(d.filter(first & (m % 13 == 0)))


@register("overlap_violations")
def overlap_violations(spark, sf_dir):
    """Q8/J12 on a dimension whose first versions were partly reopened: each
    later version with the one that covers it."""
    return Q.overlapping_validity(_damaged_members(Warehouse(spark, sf_dir)).distinct(), "member_id")


@register("dq_violations")
def dq_violations(spark, sf_dir):
    """Q4/Q6/Q7/Q12/Q16-Q22 on damaged copies: how many rows each check finds."""
    w = Warehouse(spark, sf_dir)
    t, d = w.t, _damaged_members(w)
    trips = w.trip_fact.withColumn("member_key", F.when(F.col("trip_id") % 17 == 0, "none").otherwise(F.col("member_key")))
    silver = curated_lake(t).silver.withColumn("place_key", F.lower("place_key"))
    recomputed = K.place_key(F.col("place_name"), F.col("region"))
    orders = t.orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 19 == 0, "?").otherwise(F.col("o_orderstatus")))
    keyless = t.events.withColumn("event_id", F.when(F.col("event_id") % 23 != 0, F.col("event_id")))
    source = t.events.select("event_id")
    closed = w.member_dim.withColumn("segment", F.when(F.col("member_id") % 29 == 0, S.CLOSED_SEGMENT).otherwise("OPEN"))
    role = validity_join(w.t.orders, closed, "o_custkey", F.col("o_orderdate").cast("date"), "member_id")
    childless = t.customer.select("c_custkey").join(
        t.orders.filter(F.col("o_custkey") % 31 != 0).select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    return Q.counts({
        "multiple_current": Q.multiple_current(d, "member_id"),
        "current_flag_inconsistent": Q.current_flag_inconsistent(d, "member_id"),
        "end_before_start": Q.end_before_start(d),
        "duplicate_version": Q.duplicate_keys(d, ["member_id", "version"]),
        "missing_from": Q.missing_from(source, keyless.select("event_id")),
        "null_keys": Q.null_keys(keyless, ["event_id"]),
        "orphans": Q.orphans(trips, "member_key", w.member_dim, "sk"),
        "domain": Q.domain_violations(orders, "o_orderstatus", ["F", "O", "P"]),
        "key_consistency": silver.filter(~F.col("place_key").eqNullSafe(recomputed)),
        "role_rule": role.filter(F.col("v_segment") == S.CLOSED_SEGMENT),
        "has_child": childless,
    })


@register("dq_fact_keys")
def dq_fact_keys(spark, sf_dir):
    """Q16/Q17 on the facts: rows without their dimension row, and repeated keys."""
    w = Warehouse(spark, sf_dir)
    rev, exp, sug, trip = w.revenue_fact, w.expense_fact, w.suggestion_fact, w.trip_fact
    place = w.place_dim
    return Q.counts({
        "revenue.calendar": Q.orphans(rev, "calendar_key", w.calendar, "calendar_key"),
        "revenue.customer": Q.orphans(rev, "customer_key", w.customer_dim, "customer_key"),
        "revenue.member": Q.orphans(rev, "member_key", w.member_dim, "sk"),
        "revenue.supplier": Q.orphans(rev, "supplier_key", w.supplier_dim, "supplier_key"),
        "revenue.origin": Q.orphans(rev, "origin_place_key", place, "place_key"),
        "revenue.destination": Q.orphans(rev, "destination_place_key", place, "place_key"),
        "expense.calendar": Q.orphans(exp, "calendar_key", w.calendar, "calendar_key"),
        "expense.member": Q.orphans(exp, "member_key", w.member_dim, "sk"),
        "expense.customer": Q.orphans(exp, "customer_key", w.customer_dim, "customer_key"),
        "suggestion.customer": Q.orphans(sug, "customer_key", w.customer_dim, "customer_key"),
        "trip.start": Q.orphans(trip, "start_calendar_key", w.calendar, "calendar_key"),
        "trip.end": Q.orphans(trip, "end_calendar_key", w.calendar, "calendar_key"),
        "trip.key": Q.duplicate_keys(trip, ["trip_id"]),
        "expense.key": Q.duplicate_keys(exp, ["source_id", "expense_type"]),
        "suggestion.key": Q.duplicate_keys(sug, ["suggestion_id"]),
    })


@register("scd2_newcomers")
def scd2_newcomers(spark, sf_dir):
    """Every third customer is missing from the initial load and enters by
    the feed, with its name and place from the source."""
    w = Warehouse(spark, sf_dir)
    known = w.member_initial.filter(F.col("member_id") % 3 != 0)
    return scd2_history(known, S.member_changes(w.t), S.MEMBER, "change_ts", "seq", F.to_date("change_ts"),
                        w.member_initial.select("member_id", *S.MEMBER.type1))


# ============================================================================ change feeds
QUERIES.update(feed_queries.QUERIES)
ORACLE.update({n: SQL[n] for n in feed_queries.QUERIES})
