"""Star-schema load on the stand-in sources: dimensions, calendar, the four
fact shapes and the analytic marts (D1-D12, F1-F10, V1-V8).

Plan choices that matter at scale
* Keys are deterministic: type-1 dimensions keep their stable natural id,
  the calendar uses yyyymmdd, and only the type-2 member has a surrogate
  (md5 of namespace, id and version, computed once per dimension row).
  Facts therefore compute calendar / customer / supplier / address / place
  keys inline, with no hashing and no join; only the member needs a
  (validity) join, because its key depends on the date.
* Per-order notice flags, boarding counts and revenue come from ONE hash
  aggregate of lineitem by order key; its output is already hash
  partitioned on that key, so the join to orders reuses it.
* Marts that roll facts up to places pre-aggregate per address first, so the
  fact never joins the address dimension row by row.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimforge.functions import keys as K
from dimforge.operators import calendar as cal
from dimforge.operators.joins import validity_join
from dimforge.operators.scd import scd2_history, scd2_initial
from dimforge.plans import standins as S
from dimforge.sources.tables import Tables


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, filters: dict | None = None):
        self.spark = spark
        self.t = Tables(spark, sf_dir, filters)

    @classmethod
    def over(cls, tables: Tables) -> "Warehouse":
        w = cls.__new__(cls)
        w.spark, w.t = tables.spark, tables
        return w

    def use(self, **published: DataFrame) -> "Warehouse":
        """Replace computed tables (e.g. ``member_dim``, ``calendar``) with
        published versions, so downstream facts read them instead of
        recomputing — and lineage is cut at the published table."""
        self.__dict__.update(published)
        return self

    # -- dimensions ---------------------------------------------------------
    @cached_property
    def member_initial(self) -> DataFrame:
        return scd2_initial(S.members_source(self.t), S.MEMBER)

    @cached_property
    def member_dim(self) -> DataFrame:
        """Full history: one change batch per day of the feed."""
        return scd2_history(self.member_initial, S.member_changes(self.t), S.MEMBER,
                            "change_ts", "seq", F.to_date("change_ts"))

    @cached_property
    def customer_dim(self) -> DataFrame:
        return self.t.customer.select(F.col("c_custkey").alias("customer_key"),
                                      F.col("c_custkey").alias("customer_id"),
                                      F.col("c_name").alias("customer_name"),
                                      F.col("c_mktsegment").alias("segment"),
                                      F.col("c_nationkey").alias("place_id"))

    @cached_property
    def supplier_dim(self) -> DataFrame:
        return self.t.supplier.select(F.col("s_suppkey").alias("supplier_key"),
                                      F.col("s_suppkey").alias("supplier_id"),
                                      F.col("s_name").alias("supplier_name"),
                                      F.col("s_nationkey").alias("place_id"),
                                      K.money("s_acctbal").alias("balance"))

    @cached_property
    def place_dim(self) -> DataFrame:
        return S.places(self.t).select(F.col("place_id").alias("place_key"), "place_id",
                                       "place_name", "region")

    # -- calendar -----------------------------------------------------------
    def planned_ts(self, e: DataFrame) -> F.Column:
        return e["ts"] + F.expr(f"INTERVAL {S.PLANNED_OFFSET_DAYS} DAYS")

    @cached_property
    def seen_dates(self) -> DataFrame:
        e = self.t.events
        return cal.seen_dates([(self.t.orders, "o_orderdate"), (self.t.lineitem, "l_shipdate"),
                               (e, "ts"), (e.select(self.planned_ts(e).alias("planned")), "planned")])

    @cached_property
    def calendar(self) -> DataFrame:
        return cal.calendar_rows(self.seen_dates)

    # -- trips and boardings --------------------------------------------------
    @cached_property
    def boardings(self) -> DataFrame:
        l = self.t.lineitem
        price = K.money("l_extendedprice")
        paid = F.round(price * (F.lit(1) - K.money("l_discount")), 2).cast("decimal(18,2)")
        return l.select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag",
                        price.alias("list_price"), paid.alias("paid"))

    def order_stats_for(self, b: DataFrame) -> DataFrame:
        """One hash aggregate per order: boardings, revenue, last ship date and
        the notice counts / flags (the EXISTS-per-code of the status rule)."""
        flag = F.col("l_returnflag")
        agg = b.groupBy("l_orderkey").agg(
            F.count(F.lit(1)).alias("n_boardings"), F.sum("paid").alias("revenue"),
            F.max("l_shipdate").alias("last_ship"),
            F.count_if(flag == S.CANCEL_FLAG).alias("n_cancel"),
            F.count_if(flag == S.DELAY_FLAG).alias("n_delay"))
        return (agg.withColumn("has_cancel", F.col("n_cancel") > 0)
                   .withColumn("has_delay", F.col("n_delay") > 0))

    def trips_for(self, orders: DataFrame, boardings: DataFrame) -> DataFrame:
        o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
        j = o.join(self.order_stats_for(boardings), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        end_ts = F.when(F.col("o_orderstatus") == "F", F.col("last_ship"))
        return j.select(
            "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
            end_ts.alias("end_ts"),
            K.trip_status(F.coalesce("has_cancel", F.lit(False)), F.coalesce("has_delay", F.lit(False)),
                          end_ts).alias("trip_status"),
            F.coalesce("n_boardings", F.lit(0)).alias("n_boardings"),
            F.coalesce("revenue", F.lit(0).cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"),
            F.coalesce("n_delay", F.lit(0)).alias("n_delay"),
            F.coalesce("n_cancel", F.lit(0)).alias("n_cancel"))

    @cached_property
    def trips(self) -> DataFrame:
        return self.trips_for(self.t.orders, self.boardings)

    # -- facts ----------------------------------------------------------------
    def trip_versions(self, trips: DataFrame) -> DataFrame:
        """Order-grain attributes shared by the trip and revenue facts: the
        member version in force on the order date and the customer's place.
        Both joins are keyed on the customer, so they run on orders (a
        quarter of the boardings) and share one partitioning by customer."""
        j = trips.join(self.t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        return validity_join(j, self.member_dim.select("member_id", "sk", "valid_from", "valid_to"),
                             "o_custkey", F.col("o_orderdate").cast("date"), "member_id")

    def revenue_fact_for(self, boardings: DataFrame, trips: DataFrame) -> DataFrame:
        return self._revenue(boardings, self.trip_versions(
            trips.select("o_orderkey", "o_custkey", "o_orderdate", "trip_status")))

    def revenue_fact_on(self, boardings: DataFrame, trip_fact: DataFrame) -> DataFrame:
        """``revenue_fact_for`` of the trips of a written trip fact, which has their status and member version:
        neither is worked out, nor orders and members moved, once more.  Boardings of other trips are left out."""
        o = trip_fact.select(F.col("trip_id").alias("o_orderkey"), F.col("origin_address_key").alias("o_custkey"),
                             "trip_status", F.col("member_key").alias("v_sk"))
        c = self.t.customer.select("c_custkey", "c_nationkey")
        return self._revenue(boardings, o.join(c, F.col("o_custkey") == F.col("c_custkey")))

    def _revenue(self, boardings: DataFrame, o: DataFrame) -> DataFrame:
        """Boardings meet the enriched orders once (by order key) and the
        supplier once (by supplier key): two shuffles at boarding grain."""
        j = (boardings.join(o.select("o_orderkey", "o_custkey", "trip_status", "c_nationkey", "v_sk"),
                            F.col("l_orderkey") == F.col("o_orderkey"))
             .join(self.t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")))
        return j.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").alias("paid_at"), "paid", "list_price",
            (F.col("list_price") - F.col("paid")).cast("decimal(18,2)").alias("discount"),
            "trip_status",
            K.calendar_key(F.col("l_shipdate")).alias("calendar_key"),
            F.col("o_custkey").alias("customer_key"),
            F.col("v_sk").alias("member_key"),
            F.col("l_suppkey").alias("supplier_key"),
            F.col("o_custkey").alias("origin_address_key"),
            F.col("c_nationkey").alias("origin_place_key"),
            F.col("s_nationkey").alias("destination_place_key"))

    def revenue_by_origin(self) -> DataFrame:
        """Boardings and revenue per origin address over the revenue fact's
        row set (boardings with a known supplier, on a trip whose customer
        has a member version in force), aggregated early: boardings are
        reduced to one row per order (map-side combine) before they meet
        the orders, so only one shuffle runs at boarding grain."""
        b = self.boardings.join(self.t.supplier.select(F.col("s_suppkey").alias("l_suppkey")), "l_suppkey",
                                "left_semi")
        per_order = b.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("paid").alias("amt"))
        o = self.trip_versions(self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate"))
        j = per_order.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        return j.groupBy(F.col("o_custkey").alias("origin_address_key")).agg(
            F.sum("n").alias("n"), F.sum("amt").alias("amt"))

    @cached_property
    def revenue_fact(self) -> DataFrame:
        return self.revenue_fact_for(self.boardings, self.trips)

    def revenue_by_day(self, *attributes: str) -> DataFrame:
        """Boardings and revenue per day and trip status, with calendar
        attributes: the fact is summed (map-side first) before it meets the
        calendar, so no day's boardings are shuffled."""
        sums = self.revenue_fact.groupBy("calendar_key", "trip_status").agg(
            F.count(F.lit(1)).alias("boardings"), F.sum("paid").alias("paid"))
        return sums.join(self.calendar.select("calendar_key", *attributes), "calendar_key")

    def trip_fact_for(self, trips: DataFrame) -> DataFrame:
        j = validity_join(trips, self.member_dim.select("member_id", "sk", "valid_from", "valid_to"),
                          "o_custkey", F.col("o_orderdate").cast("date"), "member_id")
        return j.select(
            F.col("o_orderkey").alias("trip_id"), F.col("o_orderdate").alias("start_ts"), "end_ts",
            "trip_status", K.money("o_totalprice").alias("price"), "n_boardings", "revenue",
            F.when(F.col("end_ts").isNotNull(), K.minutes_between("o_orderdate", "end_ts")).alias("duration_min"),
            "n_delay", "n_cancel",
            K.calendar_key(F.col("o_orderdate")).alias("start_calendar_key"),
            F.when(F.col("end_ts").isNotNull(), K.calendar_key(F.col("end_ts"))).alias("end_calendar_key"),
            F.col("v_sk").alias("member_key"),
            F.col("o_custkey").alias("origin_address_key"))

    @cached_property
    def trip_fact(self) -> DataFrame:
        return self.trip_fact_for(self.trips)

    def expense_fact_for(self, events: DataFrame, orders: DataFrame) -> DataFrame:
        pay = events.filter(F.col("event_type") == "purchase")
        pay = validity_join(pay, self.member_dim.select("member_id", "sk", "member_name", "valid_from", "valid_to"),
                            "user_id", F.col("ts").cast("date"), "member_id")
        net = K.money("value")
        tax = F.round(net * F.lit(S.PAYMENT_TAX_RATE).cast("decimal(3,2)"), 2).cast("decimal(18,2)")
        payments = pay.select(
            F.col("event_id").alias("source_id"), F.lit("Member payment").alias("expense_type"),
            F.concat(F.lit("Payment - "), F.col("v_member_name")).alias("description"),
            (net + tax).cast("decimal(18,2)").alias("amount"), net.alias("net_amount"), tax.alias("tax_amount"),
            K.calendar_key(F.col("ts")).alias("calendar_key"),
            F.col("v_sk").alias("member_key"), F.lit(None).cast("bigint").alias("customer_key"))
        fulfil = orders.select(
            F.col("o_orderkey").alias("source_id"), F.lit("Order fulfilment").alias("expense_type"),
            F.concat(F.lit("Order priority "), F.col("o_orderpriority")).alias("description"),
            K.money("o_totalprice").alias("amount"), K.money("o_totalprice").alias("net_amount"),
            F.lit(0).cast("decimal(18,2)").alias("tax_amount"),
            K.calendar_key(F.col("o_orderdate")).alias("calendar_key"),
            F.lit(None).cast("string").alias("member_key"), F.col("o_custkey").alias("customer_key"))
        return payments.unionByName(fulfil)

    @cached_property
    def expense_fact(self) -> DataFrame:
        return self.expense_fact_for(self.t.events, self.t.orders)

    def suggestion_fact_for(self, events: DataFrame) -> DataFrame:
        e = events.join(self.t.customer.select(F.col("c_custkey").alias("user_id")), "user_id", "left_semi")
        planned = self.planned_ts(e)
        return e.select(
            F.col("event_id").alias("suggestion_id"),
            K.decode("event_type", {"view": "Origin"}, "Destination").alias("kind"),
            planned.alias("planned_ts"),
            K.calendar_key(planned).alias("planned_calendar_key"),
            K.calendar_key(F.col("ts")).alias("registered_calendar_key"),
            F.col("user_id").alias("customer_key"),
            F.col("user_id").alias("address_key"))

    @cached_property
    def suggestion_fact(self) -> DataFrame:
        return self.suggestion_fact_for(self.t.events)

    # -- marts ----------------------------------------------------------------
    def penetration(self, address_dim: DataFrame) -> DataFrame:
        """Per place: addresses, population, boardings and revenue originating
        there, suggestions, and the three rates per 100k inhabitants."""
        a = address_dim
        mun = a.groupBy("place_name", "region").agg(
            F.count(F.lit(1)).alias("n_addresses"), F.max("place_code").alias("place_code"),
            F.max("population").alias("population"), F.max("population_year").alias("population_year"))
        rev_addr = self.revenue_by_origin()
        rev = (rev_addr.join(a.select(F.col("address_key").alias("origin_address_key"), "place_name", "region"),
                             "origin_address_key")
               .groupBy("place_name", "region").agg(F.sum("n").alias("boardings"),
                                                    F.sum("amt").alias("revenue")))
        sug_addr = self.suggestion_fact.groupBy("address_key").agg(F.count(F.lit(1)).alias("n"))
        sug = (sug_addr.join(a.select("address_key", "place_name", "region"), "address_key")
               .groupBy("place_name", "region").agg(F.sum("n").alias("suggestions")))
        j = mun.join(rev, ["place_name", "region"], "left").join(sug, ["place_name", "region"], "left")
        boardings = F.coalesce("boardings", F.lit(0)).cast("bigint")
        revenue = F.coalesce("revenue", F.lit(0)).cast("decimal(38,2)")
        suggestions = F.coalesce("suggestions", F.lit(0)).cast("bigint")
        return j.select(
            "place_name", "region", "place_code", "population", "population_year",
            K.size_band("population").alias("size_band"), "n_addresses",
            boardings.alias("boardings"), revenue.alias("revenue"), suggestions.alias("suggestions"),
            K.rate_per_100k(revenue, F.col("population")).alias("revenue_per_100k"),
            K.rate_per_100k(boardings, F.col("population")).alias("boardings_per_100k"),
            K.rate_per_100k(suggestions, F.col("population")).alias("suggestions_per_100k"))

    def _sources_of(self, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        k = keys.select(F.col(key).alias("o_orderkey")).distinct()
        orders = self.t.orders.join(k, "o_orderkey", "left_semi")
        return orders, self.boardings.join(k.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", "left_semi")

    def trip_facts_for_keys(self, keys: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(trip fact, revenue fact) rebuilt for the orders in ``keys`` only:
        orders and boardings are semi-joined with the (small, distinct) key
        set first, so the rebuild reads every source row once and computes
        facts only for affected trips, each with all of its boardings."""
        orders, boardings = self._sources_of(keys, key)
        trips = self.trips_for(orders, boardings)
        return self.trip_fact_for(trips), self.revenue_fact_for(boardings, trips)

    def trip_fact_for_keys(self, keys: DataFrame, key: str) -> DataFrame:
        return self.trip_fact_for(self.trips_for(*self._sources_of(keys, key)))

    def place_rates(self) -> DataFrame:
        """Every place (left joins) with customers, orders, order value, first
        order day and a supplier-based population; missing measures default
        by ``coalesce`` (0, 0.00, the far-future day) and the rates per 100k
        are NULL where the population is 0 (``nullif`` guard).  Orders are
        first reduced per customer (map-side combine, safe for a hot
        customer), so only one row per customer meets the customer table."""
        c = self.t.customer
        n_cust = c.groupBy(F.col("c_nationkey").alias("place_id")).agg(F.count(F.lit(1)).alias("n_customers"))
        per_cust = self.t.orders.groupBy("o_custkey").agg(
            F.count(F.lit(1)).alias("n"), F.sum(K.money("o_totalprice")).alias("v"),
            F.min(F.to_date("o_orderdate")).alias("f"))
        ords = (per_cust.join(c.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
                .groupBy(F.col("c_nationkey").alias("place_id"))
                .agg(F.sum("n").alias("n_orders"), F.sum("v").alias("order_value"), F.min("f").alias("first_order")))
        n_sup = self.t.supplier.groupBy(F.col("s_nationkey").alias("place_id")).agg(
            F.count(F.lit(1)).alias("n_suppliers"))
        j = (S.places(self.t).join(n_cust, "place_id", "left").join(ords, "place_id", "left")
             .join(n_sup, "place_id", "left"))
        n_orders = F.coalesce("n_orders", F.lit(0)).cast("bigint")
        value = F.coalesce("order_value", F.lit(0)).cast("decimal(38,2)")
        population = (F.coalesce("n_suppliers", F.lit(0)) * F.lit(S.PEOPLE_PER_CUSTOMER)).cast("bigint")
        return j.select(
            "place_id", "place_name", "region",
            F.coalesce("n_customers", F.lit(0)).cast("bigint").alias("n_customers"),
            n_orders.alias("n_orders"), value.alias("order_value"),
            F.coalesce("first_order", F.lit(K.VALID_TO_OPEN).cast("date")).alias("first_order_date"),
            population.alias("population"),
            K.rate_per_100k(n_orders, population).alias("orders_per_100k"),
            K.rate_per_100k(value, population).alias("order_value_per_100k"))

    def revenue_mart(self, address_dim: DataFrame) -> DataFrame:
        """Wide revenue view.  What belongs to the order or its customer (member
        version, customer, origin address) is attached at order grain, what
        belongs to the supplier (name, destination place) at supplier grain, and
        calendar attributes come from the date itself; boardings are shuffled
        for the order and for the supplier only."""
        members = self.member_dim.select("member_id", "member_name", "version", "valid_from", "valid_to")
        cu = self.customer_dim.select("customer_key", "customer_name", F.col("segment").alias("customer_segment"))
        ao = address_dim.select("address_key", F.col("place_name").alias("origin_place"),
                                F.col("population").alias("origin_population"), F.col("size_band").alias("origin_band"))
        o = validity_join(self.trips.select("o_orderkey", "o_custkey", "o_orderdate", "trip_status"), members,
                          "o_custkey", F.col("o_orderdate").cast("date"), "member_id")
        o = (o.join(cu, F.col("o_custkey") == F.col("customer_key"))
             .join(ao, F.col("o_custkey") == F.col("address_key"))
             .drop("o_custkey", "o_orderdate", "customer_key", "address_key"))
        populations = (address_dim.groupBy(F.col("place_name").alias("_name"), F.col("region").alias("_region"))
                       .agg(F.max("population").alias("destination_population")))
        places = (self.place_dim.join(populations, (F.lower("place_name") == F.col("_name"))
                                      & (F.col("region") == F.col("_region")), "left")
                  .select("place_key", F.col("place_name").alias("destination_place"), "destination_population"))
        su = (self.supplier_dim.select("supplier_key", "supplier_name", "place_id")
              .join(places, F.col("place_id") == F.col("place_key")).drop("place_id", "place_key"))
        j = (self.boardings.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(su, F.col("l_suppkey") == F.col("supplier_key")))
        day = F.col("l_shipdate").cast("date")
        return j.select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
            F.col("l_shipdate").alias("paid_at"), "paid", "list_price",
            (F.col("list_price") - F.col("paid")).cast("decimal(18,2)").alias("discount"), "trip_status",
            F.year(day).alias("year"), day.alias("full_date"), K.month_text(day).alias("month"),
            F.quarter(day).alias("quarter"), "customer_name", "customer_segment",
            F.col("v_member_name").alias("member_name"), F.col("v_version").alias("member_version"), "supplier_name",
            "origin_place", "origin_population", "origin_band", "destination_place", "destination_population",
            K.size_band("destination_population").alias("destination_band"))

