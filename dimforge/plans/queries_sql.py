"""DuckDB SQL for each registered query (see ``oracle.py`` for fragments)."""

from __future__ import annotations

from dimforge.functions import keys as K
from dimforge.plans import feed_queries
from dimforge.plans import oracle as O
from dimforge.plans import standins as S
from dimforge.plans.oracle import sql

EC = O._ts(S.EVENTS_CUT)
OC = O._ts(S.ORDERS_CUT)
AT = O._ts(S.CATALOGUE_AT)
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _counts(pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS name, (SELECT count(*) FROM ({q}) x) AS n_rows" for n, q in pairs)


def _member_state(as_of: str | None) -> str:
    where = f"WHERE change_ts < {O._ts(as_of)}" if as_of else ""
    return f"""(SELECT member_id, segment, balance FROM (
      SELECT *, row_number() OVER (PARTITION BY member_id ORDER BY change_ts DESC, seq DESC) AS rn
      FROM member_changes {where}) x WHERE rn = 1 AND segment <> '{S.CLOSED_SEGMENT}')"""


def _overlaps(dim: str) -> str:
    """Every version that starts inside an earlier one (pair join), with the earlier one that ends last."""
    far = "DATE '9999-12-31'"
    return f"""
SELECT b.member_id, max_by(a.version, struct_pack(e := coalesce(a.valid_to, {far}), v := a.version)) AS version,
       b.version AS next_version
FROM {dim} a JOIN {dim} b ON a.member_id = b.member_id
  AND (a.valid_from < b.valid_from OR (a.valid_from = b.valid_from AND a.version < b.version))
WHERE b.valid_from < coalesce(a.valid_to, {far}) AND a.valid_from < coalesce(b.valid_to, {far})
  AND coalesce(b.valid_to, {far}) >= b.valid_from
GROUP BY b.member_id, b.version"""


DIFF = f"""
SELECT coalesce(n.member_id, o.member_id) AS member_id,
       CASE WHEN o.member_id IS NULL THEN 'I' WHEN n.member_id IS NULL THEN 'D' ELSE 'U' END AS action,
       o.segment AS old_segment, o.balance AS old_balance, n.segment AS new_segment, n.balance AS new_balance
FROM {_member_state(S.SNAPSHOT_OLD_AS_OF)} o FULL OUTER JOIN {_member_state(None)} n ON o.member_id = n.member_id
WHERE o.member_id IS NULL OR n.member_id IS NULL
   OR o.segment IS DISTINCT FROM n.segment OR o.balance IS DISTINCT FROM n.balance"""

O.frag("diff", ("member_changes",), DIFF)

# fragments used only by the entries below
O.frag("member_dim_one_batch", ("member_init", "member_changes"),
       O._history_body("member_changes", "DATE '2000-01-01'"))
O.frag("expense_fact_old", ("member_dim",), O._expense_fact_body(
    f"(SELECT * FROM events WHERE ts < {EC})", f"(SELECT * FROM orders WHERE o_orderdate < {OC})"))
O.frag("expense_fact_new", ("member_dim",), O._expense_fact_body(
    f"(SELECT * FROM events WHERE ts >= {EC})", f"(SELECT * FROM orders WHERE o_orderdate >= {OC})"))

VALIDP = O.VALID.format(k="e.user_id", d="e.ts")

SQL: dict[str, str] = {
    "mart_penetration": sql("SELECT * FROM penetration", "penetration"),

    "place_key": f"""
SELECT doc_id, lang, md5({O._key_sql('text', 'lang')}) AS key_md5,
       CAST(length({O._key_sql('text', 'lang')}) AS INTEGER) AS key_length
FROM documents""",

    "size_band": sql(f"SELECT code, place_name, region, population, {O._band_sql('population')} AS size_band "
                     "FROM silver", "silver"),

    "bronze_append_once": sql("SELECT * FROM bronze", "bronze"),

    "lake_silver": sql("SELECT * FROM silver", "silver"),

    "silver_latest": """
SELECT user_id, upper(trim(event_type)) AS last_event_type, CAST(value AS DECIMAL(18,2)) AS last_value,
       ts AS last_ts, TRY_CAST(regexp_replace(props, '[^0-9]', '', 'g') AS BIGINT) AS props_number
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1""",

    "enrich_left_join": sql("SELECT * FROM address_dim", "address_dim"),

    "enrich_check": sql(_counts([
        ("addresses_in", "SELECT * FROM addr"),
        ("addresses_out", "SELECT * FROM address_dim"),
        ("silver_duplicate_keys", "SELECT place_key FROM silver GROUP BY place_key HAVING count(*) > 1"),
        ("addresses_without_population", "SELECT * FROM address_dim WHERE population IS NULL"),
    ]), "address_dim"),

    "dataset_catalogue": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS dataset, '{t}.parquet' AS source_file, {AT} AS last_import, "
        f"(SELECT count(*) FROM {t}) AS row_count" for t in TABLES),

    "gold_dim_refresh": sql("""
SELECT b.place_name, b.region, b.population_before, a.population_after,
       b.population_before IS DISTINCT FROM a.population_after AS changed
FROM (SELECT place_name, region, max(population) AS population_before FROM address_dim_v1
      GROUP BY place_name, region) b
JOIN (SELECT place_name, region, max(population) AS population_after FROM address_dim
      GROUP BY place_name, region) a ON a.place_name = b.place_name AND a.region = b.region""",
                            "address_dim_v1", "address_dim"),

    "scd1_external": sql(f"""
SELECT address_key, address_id, place_name, region,
       CASE WHEN ch THEN s_code ELSE place_code END AS place_code,
       CASE WHEN ch THEN s_pop ELSE population END AS population,
       CASE WHEN ch THEN s_year ELSE population_year END AS population_year,
       CASE WHEN ch THEN {O._band_sql('s_pop')} ELSE size_band END AS size_band,
       ch AS _changed
FROM (SELECT d.*, s.code AS s_code, s.population AS s_pop, s.ref_year AS s_year,
             coalesce(s.code IS NOT NULL AND (d.place_code IS DISTINCT FROM s.code
                 OR d.population IS DISTINCT FROM s.population
                 OR d.population_year IS DISTINCT FROM s.ref_year), false) AS ch
      FROM address_dim_v1 d LEFT JOIN silver s ON s.place_key = {O._key_sql('d.place_name', 'd.region')}) x""",
                         "address_dim_v1", "silver"),

    "gold_penetration": sql(f"""
SELECT d.place_name, d.region, max(d.population) AS population, {O._band_sql('max(d.population)')} AS size_band,
       CAST(count(e.event_id) AS BIGINT) AS suggestions,
       {O._rate_sql('count(e.event_id)', 'max(d.population)')} AS suggestions_per_100k
FROM address_dim d LEFT JOIN events e ON e.user_id = d.address_id
GROUP BY d.place_name, d.region""", "address_dim"),

    "key_consistency": sql(f"""
SELECT code, place_name, place_key, {O._key_sql('place_name', 'region')} AS recomputed_key
FROM silver WHERE place_key IS DISTINCT FROM {O._key_sql('place_name', 'region')}""", "silver"),

    "typed_refresh": sql("SELECT * FROM silver", "silver"),

    "sorted_export": sql("SELECT code, place_name, population FROM silver", "silver"),

    "calendar_dim": sql("SELECT * FROM calendar", "calendar"),

    "calendar_unseen": f"""
SELECT {O._cal_cols('d')} FROM (
  SELECT CAST(ts AS DATE) AS d FROM events UNION SELECT CAST({O.PLANNED} AS DATE) FROM events
  EXCEPT
  SELECT CAST(o_orderdate AS DATE) FROM orders EXCEPT SELECT CAST(l_shipdate AS DATE) FROM lineitem) x
WHERE d IS NOT NULL""",

    "scd2_initial": sql(f"""
SELECT {O._sk('member', 'member_id', '1')} AS sk, member_id, member_name, place_id, segment, balance,
       1 AS version, {O.SENT} AS valid_from, CAST(NULL AS DATE) AS valid_to, 'Y' AS is_current
FROM member_init""", "member_init"),

    "scd2_apply": sql("SELECT * FROM member_dim_one_batch", "member_dim_one_batch"),

    "scd2_history": sql("SELECT * FROM member_dim", "member_dim"),

    "scd2_close": sql("SELECT * FROM member_dim", "member_dim"),

    "scd2_type1_overwrite": sql("""
SELECT m.sk, m.member_id,
       CASE WHEN k.member_id IS NOT NULL THEN c.c_name || ' (' || c.c_mktsegment || ')' ELSE m.member_name END
         AS member_name,
       CASE WHEN k.member_id IS NOT NULL THEN c.c_nationkey ELSE m.place_id END AS place_id,
       m.segment, m.balance, m.version, m.valid_from, m.valid_to, m.is_current
FROM member_dim m
LEFT JOIN customer c ON c.c_custkey = m.member_id
LEFT JOIN (SELECT DISTINCT user_id AS member_id FROM events) k ON k.member_id = m.member_id""", "member_dim"),

    "current_members": sql("SELECT * FROM member_dim WHERE is_current = 'Y'", "member_dim"),

    "validity_join": sql(f"""
SELECT e.event_id, e.user_id AS member_id, CAST(e.ts AS DATE) AS paid_on, m.version AS member_version,
       m.segment AS segment_then, m.balance AS balance_then
FROM events e JOIN member_dim m ON {VALIDP}
WHERE e.event_type = 'purchase'""", "member_dim"),

    "payment_version_listing": sql("""
SELECT f.source_id, c.full_date AS paid_on, f.net_amount, m.member_id, m.member_name,
       m.version AS member_version, m.balance AS balance_then
FROM expense_fact f JOIN member_dim m ON m.sk = f.member_key JOIN calendar c ON c.calendar_key = f.calendar_key
WHERE f.expense_type = 'Member payment'""", "expense_fact", "calendar"),

    "dq_scd2_summary": sql(_counts([
        ("multiple_current", "SELECT member_id FROM member_dim WHERE is_current = 'Y' GROUP BY member_id "
                             "HAVING count(*) > 1"),
        ("current_flag_inconsistent", "SELECT * FROM member_dim WHERE (is_current = 'Y' AND valid_to IS NOT NULL) "
                                      "OR (is_current = 'N' AND valid_to IS NULL)"),
        ("overlapping_validity", "SELECT a.member_id FROM member_dim a JOIN member_dim b ON a.member_id = b.member_id "
                                 "AND b.version > a.version WHERE b.valid_from < coalesce(a.valid_to, DATE '9999-12-31') "
                                 "AND a.valid_from < coalesce(b.valid_to, DATE '9999-12-31')"),
        ("end_before_start", "SELECT * FROM member_dim WHERE valid_to < valid_from"),
        ("duplicate_version", "SELECT member_id FROM member_dim GROUP BY member_id, version HAVING count(*) > 1"),
    ]), "member_dim"),

    "overlap_pairs": sql("""
""" + _overlaps("member_dim"), "member_dim"),

    "dq_versions_per_key": sql("""
SELECT member_id, count(*) AS n_versions, count(*) FILTER (WHERE is_current = 'Y') AS n_current
FROM member_dim GROUP BY member_id""", "member_dim"),

    "fact_revenue": sql("SELECT * FROM revenue_fact", "revenue_fact"),
    "fact_trip_snapshot": sql("SELECT * FROM trip_fact", "trip_fact"),
    "fact_expense": sql("SELECT * FROM expense_fact", "expense_fact"),
    "fact_factless": sql("SELECT * FROM suggestion_fact", "suggestion_fact"),

    "status_rule": sql("SELECT trip_status, count(*) AS n_trips FROM trips GROUP BY trip_status", "trips"),

    "coalesce_nullif_rates": sql(f"""
SELECT place_id, place_name, region, n_customers, n_orders, order_value, first_order_date, population,
       {O._rate_sql('n_orders', 'population')} AS orders_per_100k,
       {O._rate_sql('order_value', 'population')} AS order_value_per_100k
FROM (
  SELECT p.place_id, p.place_name, p.region,
         CAST(coalesce(c.n_customers, 0) AS BIGINT) AS n_customers,
         CAST(coalesce(o.n_orders, 0) AS BIGINT) AS n_orders,
         CAST(coalesce(o.order_value, 0) AS DECIMAL(38,2)) AS order_value,
         coalesce(o.first_order, DATE '{K.VALID_TO_OPEN}') AS first_order_date,
         CAST(coalesce(s.n_suppliers, 0) * {S.PEOPLE_PER_CUSTOMER} AS BIGINT) AS population
  FROM places p
  LEFT JOIN (SELECT c_nationkey AS place_id, count(*) AS n_customers FROM customer GROUP BY c_nationkey) c
         ON c.place_id = p.place_id
  LEFT JOIN (SELECT cu.c_nationkey AS place_id, sum(x.n) AS n_orders, sum(x.v) AS order_value,
                    min(x.f) AS first_order
             FROM (SELECT o_custkey, count(*) AS n, sum({O._money('o_totalprice')}) AS v,
                          min(CAST(o_orderdate AS DATE)) AS f
                   FROM orders GROUP BY o_custkey) x
             JOIN customer cu ON x.o_custkey = cu.c_custkey
             GROUP BY cu.c_nationkey) o ON o.place_id = p.place_id
  LEFT JOIN (SELECT s_nationkey AS place_id, count(*) AS n_suppliers FROM supplier GROUP BY s_nationkey) s
         ON s.place_id = p.place_id) q""", "places"),

    "fact_expense_delta": sql(f"""
SELECT * FROM expense_fact_new n
WHERE NOT EXISTS (SELECT 1 FROM expense_fact_old s WHERE s.source_id = n.source_id
                  AND s.expense_type = n.expense_type)""", "expense_fact_new", "expense_fact_old"),

    "fact_except_delta": sql("SELECT * FROM expense_fact EXCEPT SELECT * FROM expense_fact_old",
                             "expense_fact", "expense_fact_old"),

    "fact_revenue_delta": sql(f"""
SELECT * FROM revenue_fact WHERE order_id IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= {OC})""",
                              "revenue_fact"),

    "fact_factless_delta": sql(f"""
SELECT * FROM suggestion_fact WHERE suggestion_id IN (SELECT event_id FROM events WHERE ts >= {EC})""",
                               "suggestion_fact"),

    "trip_replace_by_key": sql("SELECT * FROM trip_fact", "trip_fact"),

    "snapshot_diff": sql("SELECT * FROM diff", "diff"),

    "audit_log": sql(f"""
SELECT 'source' AS schema_name, 'member' AS table_name, CAST(NULL AS VARCHAR) AS user_name, {AT} AS action_ts,
       action,
       CASE WHEN action <> 'I' THEN to_json({{'member_id': member_id, 'segment': old_segment,
                                             'balance': old_balance}}) END AS original_data,
       CASE WHEN action <> 'D' THEN to_json({{'member_id': member_id, 'segment': new_segment,
                                             'balance': new_balance}}) END AS new_data
FROM diff""", "diff"),

    "typed_deltas": sql(f"""
SELECT member_id, new_segment AS segment, new_balance AS balance, 'I' AS action,
       CAST(NULL AS TIMESTAMP) AS change_ts FROM diff WHERE action = 'I'
UNION ALL
SELECT member_id, new_segment, new_balance, 'U', {AT} FROM diff WHERE action = 'U'""", "diff"),

    "quarantine_counts": """
SELECT event_type,
       count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_quarantined
FROM (SELECT event_type,
             coalesce(value IS NOT NULL AND value >= 0 AND ts IS NOT NULL
                      AND CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') IS NOT NULL
                               ELSE false END, false) AS ok
      FROM events) x
GROUP BY event_type""",

    "incremental_stream": sql("SELECT * FROM member_dim", "member_dim"),

    "dim_customer": sql("SELECT * FROM customer_dim", "customer_dim"),
    "dim_supplier": sql("SELECT * FROM supplier_dim", "supplier_dim"),
    "dim_place": sql("SELECT * FROM place_dim", "place_dim"),
    "dims_insert_only": sql("SELECT * FROM customer_dim", "customer_dim"),

    "mart_revenue": sql("""
SELECT f.order_id, f.line_no, f.paid_at, f.paid, f.list_price, f.discount, f.trip_status,
       c.year, c.full_date, c.month, c.quarter, cu.customer_name, cu.segment AS customer_segment,
       m.member_name, m.version AS member_version, su.supplier_name,
       ao.place_name AS origin_place, ao.population AS origin_population, ao.size_band AS origin_band,
       pd.place_name AS destination_place, dp.population AS destination_population,
       """ + O._band_sql("dp.population") + """ AS destination_band
FROM revenue_fact f
JOIN calendar c ON c.calendar_key = f.calendar_key
JOIN customer_dim cu ON cu.customer_key = f.customer_key
JOIN member_dim m ON m.sk = f.member_key
JOIN supplier_dim su ON su.supplier_key = f.supplier_key
JOIN address_dim ao ON ao.address_key = f.origin_address_key
JOIN place_dim pd ON pd.place_key = f.destination_place_key
LEFT JOIN (SELECT place_name, region, max(population) AS population FROM address_dim GROUP BY place_name, region) dp
  ON dp.place_name = lower(pd.place_name) AND dp.region = pd.region""",
                        "revenue_fact", "calendar", "customer_dim", "supplier_dim", "address_dim", "place_dim"),

    "mart_expense": sql("""
SELECT f.source_id, f.expense_type, f.description, f.amount, f.net_amount, f.tax_amount,
       c.year, c.full_date, c.month, c.quarter, m.member_name, m.segment AS member_segment,
       m.balance AS member_balance, m.version AS member_version, m.is_current AS member_current,
       cu.customer_name, cu.segment AS customer_segment
FROM expense_fact f JOIN calendar c ON c.calendar_key = f.calendar_key
LEFT JOIN member_dim m ON m.sk = f.member_key
LEFT JOIN customer_dim cu ON cu.customer_key = f.customer_key""", "expense_fact", "calendar", "customer_dim"),

    "mart_trip": sql("""
SELECT f.trip_id, f.start_ts, f.end_ts, f.trip_status, f.n_boardings, f.revenue, f.duration_min,
       f.n_delay, f.n_cancel, c.year, c.full_date, m.member_name, m.version AS member_version
FROM trip_fact f JOIN calendar c ON c.calendar_key = f.start_calendar_key
JOIN member_dim m ON m.sk = f.member_key""", "trip_fact", "calendar"),

    "mart_suggestion": sql("""
SELECT f.suggestion_id, f.kind, f.planned_ts, c.year, c.full_date, cu.customer_name, a.place_name, a.region,
       a.place_code, a.population, a.size_band
FROM suggestion_fact f JOIN calendar c ON c.calendar_key = f.planned_calendar_key
JOIN customer_dim cu ON cu.customer_key = f.customer_key
JOIN address_dim a ON a.address_key = f.address_key""", "suggestion_fact", "calendar", "customer_dim",
                           "address_dim"),

    "mart_cube": sql("""
SELECT c.year, f.trip_status, count(*) AS boardings, CAST(sum(f.paid) AS DECIMAL(38,2)) AS revenue,
       CAST(grouping(c.year, f.trip_status) AS INTEGER) AS grouping_level
FROM revenue_fact f JOIN calendar c ON c.calendar_key = f.calendar_key
GROUP BY CUBE (c.year, f.trip_status)""", "revenue_fact", "calendar"),

    "mart_pivot": sql(f"""
SELECT c.year,
       CAST(coalesce(sum(f.paid) FILTER (WHERE f.trip_status = '{K.STATUS_CANCELLED}'), 0) AS DECIMAL(38,2))
         AS cancelled,
       CAST(coalesce(sum(f.paid) FILTER (WHERE f.trip_status = '{K.STATUS_LATE}'), 0) AS DECIMAL(38,2))
         AS completed_late,
       CAST(coalesce(sum(f.paid) FILTER (WHERE f.trip_status = '{K.STATUS_DONE}'), 0) AS DECIMAL(38,2))
         AS completed,
       CAST(coalesce(sum(f.paid) FILTER (WHERE f.trip_status = '{K.STATUS_RUNNING}'), 0) AS DECIMAL(38,2))
         AS in_progress
FROM revenue_fact f JOIN calendar c ON c.calendar_key = f.calendar_key
GROUP BY c.year""", "revenue_fact", "calendar"),

    "dq_pk": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",

    "dq_fk_orphans": sql(_counts([
        ("orders.customer", "SELECT * FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN "
                            "(SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)"),
        ("lineitem.orders", "SELECT * FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS "
                            "(SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)"),
        ("lineitem.supplier", "SELECT * FROM lineitem l WHERE l_suppkey IS NOT NULL AND NOT EXISTS "
                              "(SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_suppkey)"),
        ("lineitem.part", "SELECT * FROM lineitem l WHERE l_partkey IS NOT NULL AND NOT EXISTS "
                          "(SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)"),
        ("events.customer", "SELECT * FROM events e WHERE user_id IS NOT NULL AND NOT EXISTS "
                            "(SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)"),
        ("customer.nation", "SELECT * FROM customer c WHERE c_nationkey IS NOT NULL AND NOT EXISTS "
                            "(SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)"),
        ("fact_trip.member", "SELECT * FROM trip_fact f WHERE member_key IS NOT NULL AND NOT EXISTS "
                             "(SELECT 1 FROM member_dim m WHERE m.sk = f.member_key)"),
    ]), "trip_fact"),

    "dq_domain": sql(_counts([
        ("lineitem.l_returnflag", "SELECT * FROM lineitem WHERE l_returnflag IS NULL OR l_returnflag NOT IN ('A','N','R')"),
        ("lineitem.l_linestatus", "SELECT * FROM lineitem WHERE l_linestatus IS NULL OR l_linestatus NOT IN ('O','F')"),
        ("orders.o_orderstatus", "SELECT * FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F','O','P')"),
        ("member.is_current", "SELECT * FROM member_dim WHERE is_current IS NULL OR is_current NOT IN ('Y','N')"),
    ]), "member_dim"),

    "dq_counts": sql(_counts([
        ("source_purchases", "SELECT * FROM events WHERE event_type = 'purchase'"),
        ("fact_member_payments", "SELECT * FROM expense_fact WHERE expense_type = 'Member payment'"),
        ("source_boardings", "SELECT * FROM lineitem"),
        ("fact_revenue", "SELECT * FROM revenue_fact"),
        ("source_trips", "SELECT * FROM orders"),
        ("fact_trip", "SELECT * FROM trip_fact"),
        ("fact_expense", "SELECT * FROM expense_fact"),
        ("fact_suggestion", "SELECT * FROM suggestion_fact"),
    ]), "expense_fact", "revenue_fact", "trip_fact", "suggestion_fact"),

    "reconcile_except": sql("""
SELECT l_orderkey AS order_id, l_linenumber AS line_no, paid FROM boardings
EXCEPT SELECT order_id, line_no, paid FROM revenue_fact""", "boardings", "revenue_fact"),

    "digest_differences": sql("""
, whole AS (SELECT l_orderkey AS order_id, l_linenumber AS line_no, paid FROM boardings),
copied AS (SELECT order_id, line_no, (CASE WHEN order_id % 89 = 0 THEN paid + 1 ELSE paid END)::DECIMAL(18,2) AS paid
           FROM whole WHERE order_id % 97 <> 0)
SELECT *, 'left' AS side FROM (FROM whole EXCEPT FROM copied)
UNION ALL SELECT *, 'right' AS side FROM (FROM copied EXCEPT FROM whole)""", "boardings"),

    "dq_one_population_per_place": sql("""
SELECT place_name, region, count(*) AS n_addresses, count(DISTINCT population) AS n_populations
FROM address_dim GROUP BY place_name, region""", "address_dim"),

    "dq_role_rule": sql(f"""
SELECT t.o_orderkey AS trip_id, t.o_custkey AS member_id, m.version AS v_version
FROM trips t JOIN member_dim m ON {O.VALID.format(k='t.o_custkey', d='t.o_orderdate')}
WHERE m.segment = '{S.CLOSED_SEGMENT}'""", "trips", "member_dim"),

    "dq_has_child": """
SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""",
}



O.frag("member_dim_cut", ("member_init",), O._history_body(
    f"(SELECT * FROM member_changes WHERE change_ts < {EC})", "CAST(change_ts AS DATE)"))
O.frag("member_changes_all", (), O.F["member_changes"][1])

_PK = {"region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
       "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
       "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
       "labels": ["doc_id"], "benchmark": ["item_id"], "pages": ["page_id"],
       "conversations": ["conv_id", "turn"], "embeddings": ["vec_id"]}
_pk_pairs = []
for _t, _k in _PK.items():
    _cols = ", ".join(_k)
    _pk_pairs.append((f"{_t}.duplicate_keys", f"SELECT {_cols} FROM {_t} GROUP BY {_cols} HAVING count(*) > 1"))
    _pk_pairs.append((f"{_t}.null_keys", f"SELECT * FROM {_t} WHERE " + " OR ".join(f"{c} IS NULL" for c in _k)))
_pk_pairs.append(("member_dim.duplicate_keys",
                  "SELECT member_id FROM member_dim GROUP BY member_id, version HAVING count(*) > 1"))
_pk_pairs.append(("calendar.duplicate_keys",
                  "SELECT calendar_key FROM calendar GROUP BY calendar_key HAVING count(*) > 1"))

_LANG = "CASE lang WHEN 'en' THEN 'English' WHEN 'fr' THEN 'French' WHEN 'de' THEN 'German' " \
        "WHEN 'es' THEN 'Spanish' WHEN 'pt' THEN 'Portuguese' ELSE 'Other' END"

SQL.update({
    "bronze_stream": sql("SELECT * FROM bronze", "bronze"),

    "dim_subtype_left": f"""
SELECT {O._sk('document', 'd.doc_id', '1')} AS sk, d.doc_id, d.source, {_LANG} AS language, l.quality, l.toxic,
       1 AS version, {O.SENT} AS valid_from, CAST(NULL AS DATE) AS valid_to, 'Y' AS is_current
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",

    "mart_rollup": sql("""
SELECT c.year, c.quarter, c.month, count(*) AS boardings, CAST(sum(f.paid) AS DECIMAL(38,2)) AS revenue,
       CAST(grouping(c.year, c.quarter, c.month) AS INTEGER) AS grouping_level
FROM revenue_fact f JOIN calendar c ON c.calendar_key = f.calendar_key
GROUP BY ROLLUP (c.year, c.quarter, c.month)""", "revenue_fact", "calendar"),

    "listing_desc": sql("SELECT * FROM penetration ORDER BY suggestions_per_100k DESC NULLS LAST, place_name, region",
                        "penetration"),

    "first_value_lookup": sql("""
SELECT a.code, a.place_name, b.population AS population_before, a.population AS population_after,
       b.population IS DISTINCT FROM a.population AS changed
FROM silver a LEFT JOIN silver_v1 b ON b.code = a.code
ORDER BY a.code LIMIT 1""", "silver", "silver_v1"),

    "dq_pk_summary": sql(_counts(_pk_pairs), "member_dim", "calendar"),

    "late_change_quarantine": sql(f"""
SELECT c.member_id, c.change_ts, c.seq, m.valid_from AS current_from
FROM member_changes c JOIN member_dim_cut m ON m.member_id = c.member_id AND m.is_current = 'Y'
WHERE c.change_ts >= {EC} - INTERVAL 3 DAY AND CAST(c.change_ts AS DATE) < m.valid_from""",
                                  "member_changes", "member_dim_cut"),
})


_TABLE_FRAGS = {"calendar": "calendar", "member_dim": "member_dim", "customer_dim": "customer_dim",
                "supplier_dim": "supplier_dim", "place_dim": "place_dim", "expense_fact": "expense_fact",
                "revenue_fact": "revenue_fact", "trip_fact": "trip_fact", "suggestion_fact": "suggestion_fact"}
_full = [(f"{n}.v1", f"SELECT * FROM {f}") for n, f in _TABLE_FRAGS.items() if n in
         ("calendar", "member_dim", "customer_dim", "supplier_dim", "place_dim")]
_full.append(("address_dim.v1", "SELECT * FROM address_dim"))
_full += [(f"{n}.v1", f"SELECT * FROM {f}") for n, f in _TABLE_FRAGS.items() if n.endswith("_fact")]
_inc = []
for _n, _f in {**_TABLE_FRAGS, "address_dim": "address_dim"}.items():
    _inc += [(f"{_n}.rows", f"SELECT * FROM {_f}"), (f"{_n}.extra", f"SELECT * FROM {_f} WHERE false"),
             (f"{_n}.missing", f"SELECT * FROM {_f} WHERE false")]
SQL.update({
    "full_load_publish": sql(_counts(_full), *_TABLE_FRAGS.values(), "address_dim"),
    "incremental_equals_full": sql(_counts(_inc), *_TABLE_FRAGS.values(), "address_dim"),
})

# -- change feeds -------------------------------------------------------------------
_fed = " UNION ALL ".join(f"SELECT 1 AS x FROM {t}" for t in ("customer", "supplier", "orders", "events"))
_stream = [("feed.consumed", f"{_fed} UNION ALL SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
           ("feed.batches", "SELECT * FROM (VALUES (1), (2), (3)) v"), ("feed.versions_by_replay", "SELECT 1 WHERE false")]
SQL["warehouse_stream"] = sql(_counts(_stream + _inc), *_TABLE_FRAGS.values(), "address_dim")
SQL.update(feed_queries.SQL)

# -- damaged inputs ----------------------------------------------------------------
SQL["silver_rejects"] = sql("""
SELECT code, n AS population, CASE WHEN n IS NULL THEN 'population' END AS reject_reason
FROM (SELECT code, TRY_CAST(regexp_replace(p, '[^0-9]', '', 'g') AS BIGINT) AS n
      FROM (SELECT *, CASE WHEN CAST(substr(code, 2) AS INTEGER) % 3 = 0 THEN 'n/a'
                           WHEN CAST(substr(code, 2) AS INTEGER) % 5 = 0 THEN repeat('9', 25)
                           ELSE '6,000,' || population END AS p,
                   row_number() OVER (PARTITION BY code ORDER BY _ingested_at DESC,
                       TRY_CAST(ref_year AS INTEGER) DESC NULLS LAST, _source_file DESC) AS rn FROM bronze) x
      WHERE rn = 1) y""", "bronze")

O.frag("damaged_once", ("member_dim",), """
SELECT * REPLACE (CASE WHEN version = 1 AND member_id % 7 = 0 THEN 'Y' ELSE is_current END AS is_current,
                  CASE WHEN version = 1 AND member_id % 7 = 0 THEN NULL
                       WHEN version = 1 AND member_id % 11 = 0 THEN CAST(valid_from - INTERVAL 1 DAY AS DATE)
                       ELSE valid_to END AS valid_to)
FROM member_dim""")
O.frag("damaged", ("damaged_once",), """
SELECT * FROM damaged_once UNION ALL SELECT * FROM damaged_once WHERE version = 1 AND member_id % 13 = 0""")

SQL["overlap_violations"] = sql(_overlaps("damaged_once"), "damaged_once")

SQL["dq_violations"] = sql(_counts([
    ("multiple_current", "SELECT member_id FROM damaged WHERE is_current = 'Y' GROUP BY member_id HAVING count(*) > 1"),
    ("current_flag_inconsistent", "SELECT * FROM damaged WHERE (is_current = 'Y') <> (valid_to IS NULL)"),
    ("end_before_start", "SELECT * FROM damaged WHERE valid_to < valid_from"),
    ("duplicate_version", "SELECT member_id FROM damaged GROUP BY member_id, version HAVING count(*) > 1"),
    ("missing_from", "SELECT DISTINCT event_id FROM events WHERE event_id % 23 = 0"),
    ("null_keys", "SELECT * FROM events WHERE event_id IS NULL OR event_id % 23 = 0"),
    ("orphans", "SELECT * FROM trip_fact WHERE trip_id % 17 = 0"),
    ("domain", "SELECT * FROM orders WHERE o_orderkey % 19 = 0 OR o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')"),
    ("key_consistency", f"SELECT * FROM silver WHERE lower(place_key) <> {O._key_sql('place_name', 'region')}"),
    ("role_rule", f"SELECT * FROM orders e JOIN member_dim m ON {O.VALID.format(k='e.o_custkey', d='e.o_orderdate')} "
                  "WHERE m.member_id % 29 = 0"),
    ("has_child", "SELECT * FROM customer WHERE c_custkey % 31 = 0 OR c_custkey NOT IN (SELECT o_custkey FROM orders)"),
]), "damaged", "trip_fact", "silver", "member_dim")


def _orphans(fact: str, fk: str, dim: str, pk: str) -> str:
    return f"SELECT * FROM {fact} f WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"


def _repeated(fact: str, *keys: str) -> str:
    return f"SELECT {keys[0]} FROM {fact} GROUP BY {', '.join(keys)} HAVING count(*) > 1"


SQL["dq_fact_keys"] = sql(_counts([
    ("revenue.calendar", _orphans("revenue_fact", "calendar_key", "calendar", "calendar_key")),
    ("revenue.customer", _orphans("revenue_fact", "customer_key", "customer_dim", "customer_key")),
    ("revenue.member", _orphans("revenue_fact", "member_key", "member_dim", "sk")),
    ("revenue.supplier", _orphans("revenue_fact", "supplier_key", "supplier_dim", "supplier_key")),
    ("revenue.origin", _orphans("revenue_fact", "origin_place_key", "place_dim", "place_key")),
    ("revenue.destination", _orphans("revenue_fact", "destination_place_key", "place_dim", "place_key")),
    ("expense.calendar", _orphans("expense_fact", "calendar_key", "calendar", "calendar_key")),
    ("expense.member", _orphans("expense_fact", "member_key", "member_dim", "sk")),
    ("expense.customer", _orphans("expense_fact", "customer_key", "customer_dim", "customer_key")),
    ("suggestion.customer", _orphans("suggestion_fact", "customer_key", "customer_dim", "customer_key")),
    ("trip.start", _orphans("trip_fact", "start_calendar_key", "calendar", "calendar_key")),
    ("trip.end", _orphans("trip_fact", "end_calendar_key", "calendar", "calendar_key")),
    ("trip.key", _repeated("trip_fact", "trip_id")),
    ("expense.key", _repeated("expense_fact", "source_id", "expense_type")),
    ("suggestion.key", _repeated("suggestion_fact", "suggestion_id")),
]), "revenue_fact", "expense_fact", "suggestion_fact", "trip_fact", "calendar", "customer_dim", "supplier_dim", "place_dim")

O.frag("known_members", ("member_init",), "SELECT * FROM member_init WHERE member_id % 3 <> 0")
_newcomers = O._history_body("member_changes", "CAST(change_ts AS DATE)")
SQL["scd2_newcomers"] = sql(_newcomers.replace("FROM member_init\n", "FROM known_members\n", 1),
                            "member_init", "known_members", "member_changes")

# the merge is another way to the rows of the join
SQL["validity_merge"] = SQL["validity_join"]

SQL["bronze_by_content"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey,
       CASE WHEN s_nationkey < 13 THEN 'a' ELSE 'other' END AS _source_file
FROM supplier WHERE s_nationkey IS NOT NULL"""
