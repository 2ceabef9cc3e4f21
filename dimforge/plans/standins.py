"""How the warehouse's source systems map onto the given tables.

The library is generic (``Scd2Spec``, ``validity_join`` ...); this module fixes
one concrete wiring so every registered query runs on the driver tables:

==================  =========================================================
member (SCD2 dim)   customer: id, name, place (type 1); segment, balance
                    (type 2).  Changes come from ``events``: user_id -> id,
                    ts -> change time, event_id -> feed sequence,
                    upper(event_type) -> segment, value -> balance.
customer (type 1)   customer, insert-only (the "passenger" role)
supplier (type 1)   supplier (the "asset" role)
address             one per customer, place text = lower(nation name) / region
place               nation + region; external population derived per nation
trip                orders (start = order date, end = last ship date if 'F')
boarding            lineitem (paid = extended price net of discount)
notice              lineitem return flag: 'R' = cancel, 'A' = delay
member payment      events of type 'purchase'
order expense       orders (total price)
suggestion          events (factless), planned 7 days after registration
==================  =========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimforge.functions import keys as K
from dimforge.operators.scd import Scd2Spec
from dimforge.sources.tables import Tables

# ---------------------------------------------------------------------------
# Fixed parameters of the stand-in wiring (run dates are parameters, never
# "now", so reruns are reproducible).
EVENTS_CUT = "2024-01-20 00:00:00"      # change feed / payments: stored < cut <= delta
ORDERS_CUT = "2000-01-01 00:00:00"      # trips and boardings: stored < cut <= delta
SNAPSHOT_OLD_AS_OF = "2024-01-02 00:00:00"
LOAD_V1_AT = "2025-01-01 00:00:00"      # ingest time of population file v1
LOAD_V2_AT = "2025-06-01 00:00:00"      # ingest time of population file v2
CATALOGUE_AT = "2025-06-01 00:00:00"
PAYMENT_TAX_RATE = "0.17"
PLANNED_OFFSET_DAYS = 7
PEOPLE_PER_CUSTOMER = 10000
CANCEL_FLAG = "R"
DELAY_FLAG = "A"
CLOSED_SEGMENT = "ERROR"                # a member whose last event is an error is closed
# ---------------------------------------------------------------------------

MEMBER = Scd2Spec(namespace="member", key="member_id",
                  type1=("member_name", "place_id"), type2=("segment", "balance"))


def ts(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def members_source(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(F.col("c_custkey").alias("member_id"), F.col("c_name").alias("member_name"),
                    F.col("c_nationkey").alias("place_id"), F.col("c_mktsegment").alias("segment"),
                    K.money("c_acctbal").alias("balance"))


def member_changes(t: Tables) -> DataFrame:
    e = t.events
    return e.select(F.col("user_id").alias("member_id"), F.col("ts").alias("change_ts"),
                    F.col("event_id").alias("seq"), F.upper("event_type").alias("segment"),
                    K.money("value").alias("balance"))


def places(t: Tables) -> DataFrame:
    """nation + region.  No broadcast hint: the planner broadcasts a side
    only when its size estimate is under ``autoBroadcastJoinThreshold`` and
    AQE re-checks the measured size, so a larger place table falls back to
    a shuffle join instead of failing."""
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("place_id"), F.col("n_name").alias("place_name"),
                    F.col("r_name").alias("region")))


def population_v1(t: Tables) -> DataFrame:
    """External 'population' file v1 (all text, as published): people per
    place derived from the customer count."""
    per = t.customer.groupBy(F.col("c_nationkey").alias("place_id")).agg(F.count(F.lit(1)).alias("n"))
    return (places(t).join(per, "place_id")
            .select(F.concat(F.lit("P"), F.lpad(F.col("place_id").cast("string"), 6, "0")).alias("code"),
                    F.col("place_name").alias("name"), F.col("region"),
                    (F.col("n") * PEOPLE_PER_CUSTOMER).cast("string").alias("population"),
                    F.lit("2022").alias("ref_year"), F.lit("customer census").alias("source")))


def population_v2(t: Tables) -> DataFrame:
    """Republication v2: only places that also host suppliers, recounted with
    suppliers included; values written with thousands separators."""
    cust = t.customer.groupBy(F.col("c_nationkey").alias("place_id")).agg(F.count(F.lit(1)).alias("nc"))
    sup = t.supplier.groupBy(F.col("s_nationkey").alias("place_id")).agg(F.count(F.lit(1)).alias("ns"))
    j = places(t).join(sup, "place_id").join(cust, "place_id", "left")
    pop = (F.coalesce(F.col("nc"), F.lit(0)) + F.col("ns")) * PEOPLE_PER_CUSTOMER
    return j.select(F.concat(F.lit("P"), F.lpad(F.col("place_id").cast("string"), 6, "0")).alias("code"),
                    F.concat(F.lit(" "), F.col("place_name"), F.lit("  ")).alias("name"),
                    F.lower("region").alias("region"),
                    F.format_number(pop, 0).alias("population"),
                    F.lit("2025").alias("ref_year"), F.lit("census with suppliers").alias("source"))


def addresses(t: Tables) -> DataFrame:
    """One address per customer; the place is written in lower case, so
    joining on raw text would miss — the normalised key is required."""
    p = places(t)
    return (t.customer.select("c_custkey", "c_nationkey")
            .join(p, F.col("c_nationkey") == F.col("place_id"))
            .select(F.col("c_custkey").alias("address_id"), F.lower("place_name").alias("place_name"),
                    F.col("region")))
