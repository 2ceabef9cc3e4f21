"""Independent SQL formulations of the registered queries, for DuckDB over
the same parquet tables (views ``region nation customer ...``).

Written from the operator semantics, not from the Spark code: windows
instead of ``max_by``, explicit joins instead of computed keys where that is
the textbook form.  Shared sub-queries are named fragments; ``sql()`` pulls
in each fragment a query needs, in dependency order.
"""

from __future__ import annotations

from dimforge.functions import keys as K
from dimforge.plans import standins as S


def _key_sql(name: str, region: str) -> str:
    return (f"upper(replace(translate(trim(regexp_replace({name}, '{K.WHITESPACE_RUN}', ' ', 'g')), "
            f"'{K.ACCENTED}', '{K.PLAIN}'), 'ß', 'ss')) || '/' || upper(trim({region}))")


def _band_sql(p: str) -> str:
    return (f"CASE WHEN {p} IS NULL THEN '{K.BAND_UNKNOWN}' WHEN {p} < {K.BAND_SMALL_MAX} THEN '{K.BAND_SMALL}' "
            f"WHEN {p} <= {K.BAND_MEDIUM_MAX} THEN '{K.BAND_MEDIUM}' ELSE '{K.BAND_LARGE}' END")


def _rate_sql(x: str, p: str) -> str:
    cents = f"CAST(round(CAST({x} AS DECIMAL(38,2)) * 100, 0) AS HUGEINT)"
    return (f"CASE WHEN nullif({p}, 0) IS NOT NULL THEN CAST(CAST((2 * {cents} * 100000 + {p}) // (2 * {p}) "
            f"AS DECIMAL(38,0)) * 0.01 AS DECIMAL(18,2)) END")


def _sk(ns: str, *cols: str) -> str:
    """Key of a dimension row: md5 surrogate for the type-2 member, yyyymmdd
    for the calendar, the natural id for type-1 dimensions."""
    if ns == "calendar":
        (d,) = cols
        return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"
    if ns not in ("member", "document"):
        (c,) = cols
        return c
    inner = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in cols)
    return f"md5('{ns}|' || {inner})"


def _status_sql(cancel: str, delay: str, end: str) -> str:
    return (f"CASE WHEN {cancel} THEN '{K.STATUS_CANCELLED}' WHEN {delay} THEN '{K.STATUS_LATE}' "
            f"WHEN {end} IS NOT NULL THEN '{K.STATUS_DONE}' ELSE '{K.STATUS_RUNNING}' END")


def _money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(18,2))"


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _cal_cols(d: str) -> str:
    return (f"{_sk('calendar', d)} AS calendar_key, {d} AS full_date, upper(strftime({d}, '%a')) AS weekday, "
            f"CAST(day({d}) AS INTEGER) AS day_of_month, strftime({d}, '%m') AS month, "
            f"CAST(quarter({d}) AS INTEGER) AS quarter, CAST(year({d}) AS INTEGER) AS year")


SENT = f"DATE '{K.VALID_FROM_SENTINEL}'"
PLANNED = f"(ts + INTERVAL {S.PLANNED_OFFSET_DAYS} DAY)"

# name -> (deps, body)
F: dict[str, tuple[tuple[str, ...], str]] = {}


def frag(name: str, deps: tuple[str, ...], body: str) -> None:
    F[name] = (deps, body)


# -- places and the population lake ------------------------------------------
frag("places", (), """
SELECT n.n_nationkey AS place_id, n.n_name AS place_name, r.r_name AS region
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")

frag("pop_v1", ("places",), f"""
SELECT 'P' || lpad(CAST(p.place_id AS VARCHAR), 6, '0') AS code, p.place_name AS name, p.region AS region,
       CAST(c.n * {S.PEOPLE_PER_CUSTOMER} AS VARCHAR) AS population, '2022' AS ref_year,
       'customer census' AS source
FROM places p JOIN (SELECT c_nationkey AS place_id, count(*) AS n FROM customer GROUP BY c_nationkey) c
  ON c.place_id = p.place_id""")

frag("pop_v2", ("places",), f"""
SELECT 'P' || lpad(CAST(p.place_id AS VARCHAR), 6, '0') AS code, ' ' || p.place_name || '  ' AS name,
       lower(p.region) AS region,
       format('{{:,}}', (coalesce(c.n, 0) + s.n) * {S.PEOPLE_PER_CUSTOMER}) AS population,
       '2025' AS ref_year, 'census with suppliers' AS source
FROM places p JOIN (SELECT s_nationkey AS place_id, count(*) AS n FROM supplier GROUP BY s_nationkey) s
  ON s.place_id = p.place_id
LEFT JOIN (SELECT c_nationkey AS place_id, count(*) AS n FROM customer GROUP BY c_nationkey) c
  ON c.place_id = p.place_id""")

frag("bronze", ("pop_v1", "pop_v2"), f"""
SELECT *, 'population_v1' AS _source_file, {_ts(S.LOAD_V1_AT)} AS _ingested_at FROM pop_v1
UNION ALL
SELECT *, 'population_v2' AS _source_file, {_ts(S.LOAD_V2_AT)} AS _ingested_at FROM pop_v2""")


def _silver_body(src: str) -> str:
    return f"""
SELECT code, trim(name) AS place_name, upper(trim(region)) AS region,
       TRY_CAST(regexp_replace(population, '[^0-9]', '', 'g') AS BIGINT) AS population,
       TRY_CAST(ref_year AS INTEGER) AS ref_year,
       {_key_sql('name', 'region')} AS place_key,
       _ingested_at AS ingested_at
FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY _ingested_at DESC,
             TRY_CAST(ref_year AS INTEGER) DESC NULLS LAST, _source_file DESC) AS rn FROM {src}) x
WHERE rn = 1 AND TRY_CAST(regexp_replace(population, '[^0-9]', '', 'g') AS BIGINT) IS NOT NULL"""


frag("silver", ("bronze",), _silver_body("bronze"))
frag("bronze_v1", ("pop_v1",), f"""
SELECT *, 'population_v1' AS _source_file, {_ts(S.LOAD_V1_AT)} AS _ingested_at FROM pop_v1""")
frag("silver_v1", ("bronze_v1",), _silver_body("bronze_v1"))

frag("addr", ("places",), """
SELECT c.c_custkey AS address_id, lower(p.place_name) AS place_name, p.region AS region
FROM customer c JOIN places p ON c.c_nationkey = p.place_id""")


def _address_dim_body(silver: str) -> str:
    return f"""
SELECT {_sk('address', 'a.address_id')} AS address_key, a.address_id, a.place_name, a.region,
       s.code AS place_code, s.population, s.ref_year AS population_year, {_band_sql('s.population')} AS size_band
FROM addr a LEFT JOIN {silver} s ON s.place_key = {_key_sql('a.place_name', 'a.region')}"""


frag("address_dim", ("addr", "silver"), _address_dim_body("silver"))
frag("address_dim_v1", ("addr", "silver_v1"), _address_dim_body("silver_v1"))

# -- member SCD2 ------------------------------------------------------------------
frag("member_init", (), """
SELECT c_custkey AS member_id, c_name AS member_name, c_nationkey AS place_id, c_mktsegment AS segment,
       CAST(c_acctbal AS DECIMAL(18,2)) AS balance
FROM customer""")

frag("member_changes", (), """
SELECT user_id AS member_id, ts AS change_ts, event_id AS seq, upper(event_type) AS segment,
       CAST(value AS DECIMAL(18,2)) AS balance
FROM events""")


def _history_body(changes: str, batch: str) -> str:
    return f"""
SELECT {_sk('member', 'v.member_id', 'v.version')} AS sk, v.member_id, i.member_name, i.place_id,
       v.segment, v.balance, v.version, v.valid_from, v.valid_to,
       CASE WHEN v.valid_to IS NULL THEN 'Y' ELSE 'N' END AS is_current
FROM (
  SELECT member_id, segment, balance, valid_from,
         CAST(row_number() OVER w AS INTEGER) AS version, lead(valid_from) OVER w AS valid_to
  FROM (
    SELECT member_id, segment, balance, init, batch,
           CASE WHEN init = 1 THEN valid_from WHEN pos = 1 THEN {SENT} ELSE valid_from END AS valid_from
    FROM (
      SELECT *, row_number() OVER w AS pos, lag(segment) OVER w AS prev_segment,
             lag(balance) OVER w AS prev_balance
      FROM (
        SELECT member_id, segment, balance, CAST(NULL AS DATE) AS batch, {SENT} AS valid_from, 1 AS init
        FROM member_init
        UNION ALL
        SELECT member_id, segment, balance, batch, CAST(change_ts AS DATE) AS valid_from, 0 AS init
        FROM (SELECT *, {batch} AS batch,
                     row_number() OVER (PARTITION BY member_id, {batch} ORDER BY change_ts DESC, seq DESC) AS rn
              FROM {changes}) c
        WHERE rn = 1
      ) u
      WINDOW w AS (PARTITION BY member_id ORDER BY init DESC, batch)
    ) u2
    WHERE pos = 1 OR segment IS DISTINCT FROM prev_segment OR balance IS DISTINCT FROM prev_balance
  ) k
  WINDOW w AS (PARTITION BY member_id ORDER BY init DESC, batch)
) v LEFT JOIN member_init i ON i.member_id = v.member_id"""


frag("member_dim", ("member_init", "member_changes"), _history_body("member_changes", "CAST(change_ts AS DATE)"))

# -- calendar ----------------------------------------------------------------------
frag("seen_dates", (), f"""
SELECT CAST(o_orderdate AS DATE) AS d FROM orders
UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
UNION SELECT CAST(ts AS DATE) FROM events
UNION SELECT CAST({PLANNED} AS DATE) FROM events""")
frag("calendar", ("seen_dates",), f"SELECT {_cal_cols('d')} FROM seen_dates WHERE d IS NOT NULL")

# -- trips, boardings, facts ---------------------------------------------------------
frag("boardings", (), f"""
SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag,
       {_money('l_extendedprice')} AS list_price,
       CAST(round({_money('l_extendedprice')} * (1 - {_money('l_discount')}), 2) AS DECIMAL(18,2)) AS paid
FROM lineitem""")


def _trips_body(boardings: str, orders: str) -> str:
    return f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_totalprice,
       CASE WHEN o.o_orderstatus = 'F' THEN st.last_ship END AS end_ts,
       {_status_sql("coalesce(st.n_cancel, 0) > 0", "coalesce(st.n_delay, 0) > 0",
                    "CASE WHEN o.o_orderstatus = 'F' THEN st.last_ship END")} AS trip_status,
       coalesce(st.n_boardings, 0) AS n_boardings,
       CAST(coalesce(st.revenue, 0) AS DECIMAL(38,2)) AS revenue,
       coalesce(st.n_delay, 0) AS n_delay, coalesce(st.n_cancel, 0) AS n_cancel
FROM {orders} o LEFT JOIN (
  SELECT l_orderkey, count(*) AS n_boardings, sum(paid) AS revenue, max(l_shipdate) AS last_ship,
         count(*) FILTER (WHERE l_returnflag = '{S.CANCEL_FLAG}') AS n_cancel,
         count(*) FILTER (WHERE l_returnflag = '{S.DELAY_FLAG}') AS n_delay
  FROM {boardings} GROUP BY l_orderkey) st ON st.l_orderkey = o.o_orderkey"""


frag("trips", ("boardings",), _trips_body("boardings", "orders"))

VALID = ("m.member_id = {k} AND CAST({d} AS DATE) >= m.valid_from "
         "AND (m.valid_to IS NULL OR CAST({d} AS DATE) < m.valid_to)")


def _revenue_fact_body(boardings: str, trips: str) -> str:
    return f"""
SELECT b.l_orderkey AS order_id, b.l_linenumber AS line_no, b.l_shipdate AS paid_at, b.paid, b.list_price,
       CAST(b.list_price - b.paid AS DECIMAL(18,2)) AS discount, t.trip_status,
       {_sk('calendar', 'CAST(b.l_shipdate AS DATE)')} AS calendar_key,
       {_sk('customer', 't.o_custkey')} AS customer_key, m.sk AS member_key,
       {_sk('supplier', 'b.l_suppkey')} AS supplier_key,
       {_sk('address', 't.o_custkey')} AS origin_address_key,
       {_sk('place', 'c.c_nationkey')} AS origin_place_key,
       {_sk('place', 's.s_nationkey')} AS destination_place_key
FROM {boardings} b JOIN {trips} t ON b.l_orderkey = t.o_orderkey
JOIN customer c ON t.o_custkey = c.c_custkey
JOIN supplier s ON b.l_suppkey = s.s_suppkey
JOIN member_dim m ON {VALID.format(k='t.o_custkey', d='t.o_orderdate')}"""


frag("revenue_fact", ("boardings", "trips", "member_dim"), _revenue_fact_body("boardings", "trips"))


def _trip_fact_body(trips: str) -> str:
    return f"""
SELECT t.o_orderkey AS trip_id, t.o_orderdate AS start_ts, t.end_ts, t.trip_status,
       {_money('t.o_totalprice')} AS price, t.n_boardings, t.revenue,
       CASE WHEN t.end_ts IS NOT NULL THEN
         CAST(round(date_diff('microsecond', t.o_orderdate, t.end_ts) / 60000000.0) AS BIGINT) END AS duration_min,
       t.n_delay, t.n_cancel,
       {_sk('calendar', 'CAST(t.o_orderdate AS DATE)')} AS start_calendar_key,
       CASE WHEN t.end_ts IS NOT NULL THEN {_sk('calendar', 'CAST(t.end_ts AS DATE)')} END AS end_calendar_key,
       m.sk AS member_key, {_sk('address', 't.o_custkey')} AS origin_address_key
FROM {trips} t JOIN member_dim m ON {VALID.format(k='t.o_custkey', d='t.o_orderdate')}"""


frag("trip_fact", ("trips", "member_dim"), _trip_fact_body("trips"))


def _expense_fact_body(events: str, orders: str) -> str:
    tax = f"CAST(round({_money('e.value')} * {S.PAYMENT_TAX_RATE}, 2) AS DECIMAL(18,2))"
    return f"""
SELECT e.event_id AS source_id, 'Member payment' AS expense_type, 'Payment - ' || m.member_name AS description,
       CAST({_money('e.value')} + {tax} AS DECIMAL(18,2)) AS amount, {_money('e.value')} AS net_amount,
       {tax} AS tax_amount, {_sk('calendar', 'CAST(e.ts AS DATE)')} AS calendar_key,
       m.sk AS member_key, CAST(NULL AS BIGINT) AS customer_key
FROM {events} e JOIN member_dim m ON {VALID.format(k='e.user_id', d='e.ts')}
WHERE e.event_type = 'purchase'
UNION ALL
SELECT o_orderkey, 'Order fulfilment', 'Order priority ' || o_orderpriority, {_money('o_totalprice')},
       {_money('o_totalprice')}, CAST(0 AS DECIMAL(18,2)), {_sk('calendar', 'CAST(o_orderdate AS DATE)')},
       CAST(NULL AS VARCHAR), {_sk('customer', 'o_custkey')}
FROM {orders}"""


frag("expense_fact", ("member_dim",), _expense_fact_body("events", "orders"))


def _suggestion_fact_body(events: str) -> str:
    return f"""
SELECT event_id AS suggestion_id, CASE event_type WHEN 'view' THEN 'Origin' ELSE 'Destination' END AS kind,
       {PLANNED} AS planned_ts, {_sk('calendar', f'CAST({PLANNED} AS DATE)')} AS planned_calendar_key,
       {_sk('calendar', 'CAST(ts AS DATE)')} AS registered_calendar_key,
       {_sk('customer', 'user_id')} AS customer_key, {_sk('address', 'user_id')} AS address_key
FROM {events} WHERE user_id IN (SELECT c_custkey FROM customer)"""


frag("suggestion_fact", (), _suggestion_fact_body("events"))

# -- dims (type 1) ---------------------------------------------------------------------
frag("customer_dim", (), f"""
SELECT {_sk('customer', 'c_custkey')} AS customer_key, c_custkey AS customer_id, c_name AS customer_name,
       c_mktsegment AS segment, c_nationkey AS place_id FROM customer""")
frag("supplier_dim", (), f"""
SELECT {_sk('supplier', 's_suppkey')} AS supplier_key, s_suppkey AS supplier_id, s_name AS supplier_name,
       s_nationkey AS place_id, {_money('s_acctbal')} AS balance FROM supplier""")
frag("place_dim", ("places",), f"""
SELECT {_sk('place', 'place_id')} AS place_key, place_id, place_name, region FROM places""")

# -- marts -------------------------------------------------------------------------------
frag("penetration", ("address_dim", "revenue_fact", "suggestion_fact"), f"""
SELECT mun.place_name, mun.region, mun.place_code, mun.population, mun.population_year,
       {_band_sql('mun.population')} AS size_band, mun.n_addresses,
       CAST(coalesce(r.boardings, 0) AS BIGINT) AS boardings,
       CAST(coalesce(r.revenue, 0) AS DECIMAL(38,2)) AS revenue,
       CAST(coalesce(s.suggestions, 0) AS BIGINT) AS suggestions,
       {_rate_sql('coalesce(r.revenue, 0)', 'mun.population')} AS revenue_per_100k,
       {_rate_sql('coalesce(r.boardings, 0)', 'mun.population')} AS boardings_per_100k,
       {_rate_sql('coalesce(s.suggestions, 0)', 'mun.population')} AS suggestions_per_100k
FROM (SELECT place_name, region, count(*) AS n_addresses, max(place_code) AS place_code,
             max(population) AS population, max(population_year) AS population_year
      FROM address_dim GROUP BY place_name, region) mun
LEFT JOIN (SELECT a.place_name, a.region, count(*) AS boardings, sum(f.paid) AS revenue
           FROM revenue_fact f JOIN address_dim a ON a.address_key = f.origin_address_key
           GROUP BY a.place_name, a.region) r ON r.place_name = mun.place_name AND r.region = mun.region
LEFT JOIN (SELECT a.place_name, a.region, count(*) AS suggestions
           FROM suggestion_fact f JOIN address_dim a ON a.address_key = f.address_key
           GROUP BY a.place_name, a.region) s ON s.place_name = mun.place_name AND s.region = mun.region""")


def sql(final: str, *needs: str) -> str:
    """``WITH`` every fragment ``needs`` (transitively), then ``final``."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in F[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS ({F[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{final}"
