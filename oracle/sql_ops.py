"""DuckDB SQL for the ingestion, table-statement, quality and scalar queries."""

from __future__ import annotations

from oracle.sql import CTES, LINE_COLS, ic, msum, rnd, std, xavg
from quayside.contracts import SCHEMAS

CUTOFF = "1998-01-01"
OVERLAP_FROM = "1997-01-01"
PREV_EXTRACT_BEFORE = "2000-01-01"
CUR_EXTRACT_FROM = "1995-06-01"


def q(body: str, text=(), bigint=(), extra_ctes: str = "") -> str:
    rep = [f"CAST({c} AS VARCHAR) AS {c}" for c in text] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigint]
    r = f" REPLACE ({', '.join(rep)})" if rep else ""
    ctes = CTES + ("," + extra_ctes if extra_ctes else "")
    return f"SELECT *{r} FROM ({ctes}\n{body}) q"


ORDER_CONTRACT = """
  SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id,
    CAST(restaurant_id AS VARCHAR) AS restaurant_id, order_placed_at, order_status, payment_method,
    payment_status, platform, subtotal, discount_pct, discount_amount, coupon_code, delivery_fee,
    tax_amount, total_amount, num_items, special_instructions, _ingested_at, _source_system
  FROM a_orders"""

GUIDE = f"""
gc AS (
  SELECT c.c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    lower(replace(c_name, '#', '')) || '@example.com' AS email,
    '555-' || lpad(CAST(c.c_custkey AS VARCHAR), 4, '0') AS phone,
    CAST(first_order_date AS DATE) AS created_date, n_name AS country, c_acctbal >= 0 AS is_active
  FROM customer c LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN a_first_order f ON c.c_custkey = f.c_custkey),
gs AS (
  SELECT l_orderkey * 10 + l_linenumber AS order_id, o_custkey AS customer_id,
    CAST(l_shipdate AS DATE) AS order_date, 'PROD-' || CAST(l_partkey AS VARCHAR) AS product_code,
    CAST(l_quantity AS INTEGER) AS quantity,
    ((CAST(CAST(l_extendedprice AS DECIMAL(10,2)) * 100 AS BIGINT) * 2 + CAST(l_quantity AS INTEGER))
      // (2 * CAST(l_quantity AS INTEGER))) / 100.0 AS unit_price,
    CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS total_amount,
    CASE WHEN l_linestatus = 'F' THEN 'COMPLETED' ELSE 'PENDING' END AS status
  FROM a_lines JOIN orders ON l_orderkey = o_orderkey),
gc_upd AS (
  SELECT * REPLACE (CASE WHEN country = 'NATION_3' AND contains(email, '1') THEN false ELSE is_active END
                    AS is_active)
  FROM gc),
g_join AS (
  SELECT c.customer_id, c.first_name || ' ' || c.last_name AS customer_name, c.country, o.order_id,
    o.order_date, o.product_code, o.quantity, o.total_amount, o.status
  FROM gc c JOIN gs o ON c.customer_id = o.customer_id WHERE c.is_active)"""


def _counts(items: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{a}' AS layer, '{b}' AS table_name, (SELECT count(*) FROM {src}) AS row_count"
                               for a, b, src in items)


LAYERS = ([("bronze", n, f"a_{n}") for n in ["customers", "restaurants", "orders", "deliveries", "reviews"]]
          + [("silver", n, f"s_{n}") for n in ["customers", "restaurants", "orders", "deliveries", "reviews"]]
          + [("gold", n, src) for n, src in [
              ("fact_orders", "g_fact"), ("dim_customers", "g_dim_customers"), ("dim_restaurants", "g_dim_restaurants"),
              ("agg_daily_city_metrics", "g_daily"), ("agg_restaurant_performance", "g_perf"),
              ("agg_customer_cohorts", "g_cohorts"), ("agg_delivery_sla_report", "g_sla"),
              ("agg_revenue_summary", "g_revenue")]])

ENTITIES = ["customers", "restaurants", "orders", "deliveries", "reviews"]
CUSTOMER_COLS = [f.name for f in SCHEMAS["customers"].fields]
ORDER_COLS = [f.name for f in SCHEMAS["orders"].fields]
# every other column in table order breaks ties
REPLAY_TIES = [*LINE_COLS[:2], "l_linenumber", *LINE_COLS[2:]]

DQ = f"""
dq_raw AS (
  SELECT 'customers' AS t,
    (SELECT count(*) FROM a_customers) AS input_rows, (SELECT count(*) FROM s_customers_all) AS deduped,
    (SELECT count(*) FROM s_customers) AS output_rows,
    (SELECT coalesce(sum(_nulls_filled), 0) FROM s_customers_all WHERE _reject_reason IS NULL) AS nulls_filled
  UNION ALL SELECT 'restaurants', (SELECT count(*) FROM a_restaurants), (SELECT count(*) FROM s_rest_0),
    (SELECT count(*) FROM s_restaurants),
    (SELECT coalesce(sum(CAST(is_delivering_now IS NULL AS INTEGER) + CAST(has_online_delivery IS NULL AS INTEGER)
        + CAST(has_table_booking IS NULL AS INTEGER) + CAST(is_premium_partner IS NULL AS INTEGER)), 0)
     FROM s_rest_0 WHERE restaurant_id IN (SELECT restaurant_id FROM s_restaurants))
  UNION ALL SELECT 'orders', (SELECT count(*) FROM a_orders), (SELECT count(*) FROM s_orders_conformed),
    (SELECT count(*) FROM s_orders), 0
  UNION ALL SELECT 'deliveries', (SELECT count(*) FROM a_deliveries), (SELECT count(*) FROM s_deliveries_conformed),
    (SELECT count(*) FROM s_deliveries), 0
  UNION ALL SELECT 'reviews', (SELECT count(*) FROM a_reviews), (SELECT count(*) FROM s_rev_0),
    (SELECT count(*) FROM s_reviews), 0),
dq AS (
  SELECT t AS "table", input_rows, output_rows, input_rows - deduped AS duplicates_removed,
    CAST(nulls_filled AS BIGINT) AS nulls_filled, deduped - output_rows AS quarantined,
    {rnd('output_rows / greatest(input_rows, 1) * 100', 2)} AS pass_rate_pct
  FROM dq_raw)"""

BUCKETS = [("s_customers", "customer_segment"), ("s_restaurants", "price_tier"), ("s_restaurants", "rating_tier"),
           ("s_orders", "order_time_slot"), ("s_deliveries", "delivery_sla_status"),
           ("s_deliveries", "distance_bucket"), ("g_dim_customers", "rfm_segment"),
           ("s_reviews", "sentiment_label"), ("g_perf", "performance_tier")]

CHANGE = f"""
ch_prev AS (
  SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{PREV_EXTRACT_BEFORE}'
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in ['l_shipdate'] + LINE_COLS)}) = 1),
ch_cur AS (
  SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUR_EXTRACT_FROM}' OR l_shipdate IS NULL
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in ['l_shipdate'] + LINE_COLS)}) = 1)"""

_same = " AND ".join(f"CAST(p.{c} AS VARCHAR) IS NOT DISTINCT FROM CAST(c.{c} AS VARCHAR)"
                     for c in LINE_COLS + ["l_shipdate"])

PRICING = """
pr_lines AS (
  SELECT l_orderkey, CAST(l_quantity AS INTEGER) AS qty,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price_cents,
    CAST(round(l_discount * 100) AS BIGINT) AS disc_pct
  FROM a_lines),
pr_orders AS (
  SELECT l_orderkey, sum(((2 * price_cents + qty) // (2 * qty)) * qty) AS subtotal_c,
    max(disc_pct) AS pct, count(*) AS num_items
  FROM pr_lines GROUP BY l_orderkey),
pr_1 AS (SELECT *, (2 * subtotal_c * pct + 100) // 200 AS discount_c, num_items * 500 AS fee_c FROM pr_orders),
pr_2 AS (SELECT *, (2 * (subtotal_c - discount_c) * 5 + 100) // 200 AS tax_c FROM pr_1)"""

OPS_SQL: dict[str, str] = {
    "scan_contract": q(ORDER_CONTRACT, bigint=["num_items"]),
    "full_load": q(ORDER_CONTRACT, bigint=["num_items"]),
    "scan_lineage": q("""SELECT count(*) AS row_count, count(*) AS rows_with_source_file,
                           count(DISTINCT delivery_id) AS distinct_keys FROM a_deliveries"""),
    "row_hash": q("""SELECT l_orderkey, l_linenumber,
        sha256(concat_ws('||', l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS _row_hash
        FROM a_lines""", bigint=["l_linenumber"]),
    "sink_parquet_roundtrip": q("SELECT * FROM g_daily", text=["order_date"], bigint=["order_year", "order_month"]),
    "sink_csv_roundtrip": q("SELECT * FROM g_daily", text=["order_date"], bigint=["order_year", "order_month"]),
    "sink_json_roundtrip": q("SELECT * FROM g_daily", text=["order_date"], bigint=["order_year", "order_month"]),
    "landing_counts": q("\nUNION ALL ".join(f"SELECT '{n}' AS entity, (SELECT count(*) FROM a_{n}) AS row_count"
                                            for n in ["customers", "restaurants", "orders", "deliveries", "reviews"])),
    "bronze_run_status": q("\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", 'SUCCESS' AS status, (SELECT count(*) FROM a_{n}) AS records"
        for n in ["customers", "restaurants", "orders", "deliveries", "reviews"])),
    "load_routing": q("""SELECT 'full' AS first_mode, 'incremental' AS second_mode, count(*) AS first_records,
                            count(*) AS records, count(DISTINCT order_id) AS distinct_keys FROM a_orders"""),
    "merge_upsert": q("SELECT * FROM a_lines", text=["l_shipdate"], bigint=["l_linenumber"]),
    "incremental_gold": q("SELECT * FROM g_daily", text=["order_date"], bigint=["order_year", "order_month"]),
    "stream_bronze": q(f"SELECT *, 0 AS late_rows, true AS several_batches FROM ({ORDER_CONTRACT})", bigint=["num_items", "late_rows"]),
    "distinct_rollup": q("""
        SELECT 'day' AS level, CAST(order_year AS VARCHAR) AS order_year, CAST(order_month AS VARCHAR) AS order_month,
          CAST(order_date AS VARCHAR) AS order_date, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT restaurant_id) AS active_restaurants
        FROM g_fact GROUP BY order_year, order_month, order_date
        UNION ALL SELECT 'month', CAST(order_year AS VARCHAR), CAST(order_month AS VARCHAR), NULL, count(DISTINCT customer_id), count(DISTINCT restaurant_id)
        FROM g_fact GROUP BY order_year, order_month
        UNION ALL SELECT 'total', NULL, NULL, NULL, count(DISTINCT customer_id), count(DISTINCT restaurant_id) FROM g_fact"""),
    "median_sketch": q("""
        SELECT 'month' AS level, CAST(order_year AS VARCHAR) AS order_year, CAST(order_month AS VARCHAR) AS order_month,
          count(total_amount) AS n, true AS within_bound
        FROM s_orders WHERE is_delivered GROUP BY order_year, order_month
        UNION ALL SELECT 'total', NULL, NULL, count(total_amount), true FROM s_orders WHERE is_delivered"""),
    "pruned_months": q(f"""
        SELECT customer_city, order_year, order_month, count(order_id) AS orders, {rnd(msum('total_amount'), 2)} AS gmv
        FROM g_fact JOIN (SELECT order_year, order_month FROM g_revenue WHERE gmv_growth_pct > 10) USING (order_year, order_month)
        WHERE is_delivered GROUP BY customer_city, order_year, order_month""", bigint=["order_year", "order_month"]),
    "landing_corrupt": q("""
        SELECT order_id, CASE WHEN order_id % 97 = 0 OR order_id % 89 = 0 THEN 'bad' ELSE 'good' END AS landed,
          CASE WHEN order_id % 97 <> 0 AND order_id % 89 <> 0 THEN total_amount END AS total_amount FROM a_orders"""),
    "merge_bucketed": q(f"""SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '{OVERLAP_FROM}' OR l_shipdate IS NULL THEN 'increment' END AS load_id
        FROM a_lines""", text=["l_shipdate"], bigint=["l_linenumber"]),
    "alter_table": q("""SELECT *, CAST(NULL AS VARCHAR) AS loyalty_tier, CAST(NULL AS INTEGER) AS loyalty_points,
                          true AS files_unchanged FROM gc""", text=["created_date"], bigint=["loyalty_points"], extra_ctes=GUIDE),
    "change_classes": q(f"""
        SELECT coalesce(p.l_orderkey, c.l_orderkey) AS l_orderkey, coalesce(p.l_linenumber, c.l_linenumber) AS l_linenumber,
          CASE WHEN p.l_orderkey IS NULL THEN 'new' WHEN c.l_orderkey IS NULL THEN 'missing'
               WHEN {_same} THEN 'unchanged' ELSE 'changed' END AS change_class
        FROM ch_prev p FULL OUTER JOIN ch_cur c ON p.l_orderkey = c.l_orderkey AND p.l_linenumber = c.l_linenumber""",
                        bigint=["l_linenumber"], extra_ctes=CHANGE),
    "insert_rows": q("SELECT * FROM gs", text=["order_date"], bigint=["quantity"], extra_ctes=GUIDE),
    "partitioned_write": q("SELECT * FROM gs", text=["order_date"], bigint=["quantity"], extra_ctes=GUIDE),
    "external_table": q("SELECT * FROM gs", text=["order_date"], bigint=["quantity"], extra_ctes=GUIDE),
    "update_where": q("SELECT * FROM gc_upd", text=["created_date"], extra_ctes=GUIDE),
    "delete_where": q("SELECT * FROM gc_upd WHERE NOT coalesce(is_active = false, false)", text=["created_date"],
                      extra_ctes=GUIDE),
    "evolve_schema": q("""SELECT customer_id, first_name, last_name, email, phone AS phone_number, created_date,
                            country, CAST(NULL AS VARCHAR) AS loyalty_tier, is_active FROM gc""",
                       text=["created_date"], extra_ctes=GUIDE),
    "apply_defaults": q("""SELECT * REPLACE (coalesce(CASE WHEN created_date IS NOT NULL THEN is_active END, true)
                             AS is_active),
                           CASE WHEN customer_id IS NULL THEN 'customer_id' WHEN first_name IS NULL THEN 'first_name'
                                WHEN last_name IS NULL THEN 'last_name' END AS _not_null_violation
                         FROM gc""", text=["created_date"], extra_ctes=GUIDE),
    "ctas_join": q("SELECT * FROM g_join", text=["order_date"], bigint=["quantity"], extra_ctes=GUIDE),
    "ctas_aggregate": q(f"""
        SELECT customer_id, customer_name, country, count(order_id) AS total_orders,
          CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DOUBLE) AS total_revenue,
          {xavg('total_amount', 2, 6)} AS avg_order_value, max(order_date) AS last_order_date
        FROM g_join WHERE status = 'COMPLETED' GROUP BY customer_id, customer_name, country""",
                        text=["last_order_date"], extra_ctes=GUIDE),
    "quarantine_report": q("""
        SELECT _reject_reason AS reason, count(*) AS rows, 'customers' AS "table" FROM s_customers_all
          WHERE _reject_reason IS NOT NULL GROUP BY _reject_reason
        UNION ALL SELECT _reject_reason, count(*), 'orders' FROM s_orders_rejected GROUP BY _reject_reason
        UNION ALL SELECT 'unknown_order_id', count(*), 'deliveries' FROM s_deliveries_conformed d
          WHERE NOT EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = d.order_id) HAVING count(*) > 0
        UNION ALL SELECT CASE WHEN review_id IS NULL THEN 'null_review_id' ELSE 'invalid_rating' END, count(*),
          'reviews' FROM s_rev_1 WHERE review_id IS NULL OR rating IS NULL GROUP BY 1
        UNION ALL SELECT CASE WHEN restaurant_id IS NULL THEN 'null_restaurant_id' ELSE 'null_name' END, count(*),
          'restaurants' FROM s_rest_0 WHERE restaurant_id IS NULL OR name IS NULL GROUP BY 1"""),
    "dq_metrics": q("SELECT * FROM dq", extra_ctes=DQ),
    "dq_status": q("""SELECT "table", pass_rate_pct, CASE WHEN pass_rate_pct >= 95 THEN 'PASS'
                        WHEN pass_rate_pct >= 80 THEN 'WARN' ELSE 'FAIL' END AS status FROM dq""", extra_ctes=DQ),
    "dq_gate": q(f"""
        SELECT "table", chk AS "check", value, "limit",
          coalesce(CASE WHEN op = '>=' THEN value >= "limit" ELSE value <= "limit" END, false) AS passed
        FROM (
          SELECT "table", 'min_pass_rate_pct' AS chk, CAST(pass_rate_pct AS DOUBLE) AS value, 95.0::DOUBLE AS "limit", '>=' AS op FROM dq
          UNION ALL SELECT "table", 'max_null_pct', 0.0::DOUBLE, 5.0::DOUBLE, '<=' FROM dq
          UNION ALL SELECT "table", 'max_duplicate_pct', {rnd('duplicates_removed / greatest(input_rows, 1) * 100', 2)},
                           1.0::DOUBLE, '<=' FROM dq
          UNION ALL SELECT "table", 'min_row_count', CAST(output_rows AS DOUBLE),
                           CASE "table" WHEN 'customers' THEN 1000 WHEN 'restaurants' THEN 100 WHEN 'orders' THEN 10000
                                        WHEN 'deliveries' THEN 5000 ELSE 5000 END::DOUBLE, '>=' FROM dq)""",
                 extra_ctes=DQ),
    "layer_counts": q("SELECT * FROM lc UNION ALL SELECT 'gold', 'never_written', -1 UNION ALL SELECT 'all', 'total', sum(row_count) FROM lc",
                      bigint=["row_count"], extra_ctes=f"lc AS ({_counts(LAYERS)})"),
    "run_metrics": q("\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{('transform_' if layer == 'silver' else 'build_') + name}' AS task, "
        f"'{name}' AS table_name, 'SUCCESS' AS status, (SELECT count(*) FROM {src}) AS total_records"
        for layer, name, src in LAYERS if layer != "bronze")),
    "filter_regex": q("SELECT customer_id, email, _reject_reason FROM s_customers_all WHERE _reject_reason = 'invalid_email'"),
    "filter_isin": q("""SELECT order_status, is_delivered, is_cancelled, count(*) AS orders FROM s_orders
                        GROUP BY order_status, is_delivered, is_cancelled"""),
    "filter_between": q("""SELECT rating AS raw_rating, count(*) AS reviews,
                             CASE WHEN rating BETWEEN 1 AND 5 THEN rating END AS rating
                           FROM a_reviews GROUP BY rating""", bigint=["raw_rating", "rating"]),
    "nullify_invalid": q("""SELECT delivery_rating AS raw_rating,
                              CASE WHEN delivery_rating BETWEEN 1 AND 5 THEN delivery_rating END AS delivery_rating,
                              count(*) AS deliveries
                            FROM a_deliveries GROUP BY 1, 2""", bigint=["raw_rating", "delivery_rating"]),
    "clamp_negative": q("""SELECT c_custkey, c_acctbal, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END
                             AS balance_clamped FROM customer"""),
    "safe_pct": q(f"""
        SELECT c.customer_id, coalesce(o.delivered_orders, 0) AS delivered_orders,
          {rnd('coalesce(o.discounted_delivered, 0) / CASE WHEN o.delivered_orders > 0 THEN o.delivered_orders ELSE 1 END * 100', 2)}
            AS discounted_pct
        FROM s_customers c LEFT JOIN (
          SELECT customer_id, count(*) FILTER (WHERE is_delivered) AS delivered_orders,
            count(*) FILTER (WHERE is_delivered AND has_discount) AS discounted_delivered
          FROM s_orders GROUP BY customer_id) o ON c.customer_id = o.customer_id"""),
    "bucket_battery": q("\nUNION ALL ".join(
        f"SELECT {col} AS label, count(*) AS rows, '{col}' AS bucket FROM {src} GROUP BY {col}"
        for src, col in BUCKETS)),
    "scalar_battery": q(f"""
        SELECT conv_id, turn, length(text) AS n_chars, length(trim(text)) AS n_chars_trimmed,
          sha256({ic('trim(text)')}) AS initcap_sha, sha256(lower(text)) AS lower_sha,
          sha256(upper(role)) AS upper_role_sha, regexp_replace(text, '[^0-9+]', '', 'g') AS digits,
          (role || ': ' || text) IS NULL AS concat_is_null,
          length(concat_ws(' | ', role, NULL, role)) AS concat_ws_len,
          len(string_split(text, ' ')) AS n_space_parts, md5(text) AS text_md5,
          upper(trim(role)) AS role_upper, {ic('role')} AS role_initcap
        FROM conversations"""),
    "standardize_text": q(f"""SELECT restaurant_id, {std('name')} AS name, {std('city')} AS city,
                                {std('locality')} AS locality FROM a_restaurants"""),
    "surrogate_key": q("""SELECT o_orderkey, 'ORD_' || substr(md5('ord_' || CAST(o_orderkey AS VARCHAR)), 1, 8)
                            AS order_ref FROM orders"""),
    "order_pricing": q("""
        SELECT l_orderkey, subtotal_c / 100.0 AS subtotal, CAST(pct AS DOUBLE) AS discount_pct,
          discount_c / 100.0 AS discount_amount, fee_c / 100.0 AS delivery_fee, tax_c / 100.0 AS tax_amount,
          (subtotal_c - discount_c + fee_c + tax_c) / 100.0 AS total_amount, num_items
        FROM pr_2""", extra_ctes=PRICING),
    "delivery_timeline": q("""
        SELECT delivery_id, order_id, pickup_timestamp, delivered_timestamp, delivery_time_mins,
          date_diff('minute', pickup_timestamp, delivered_timestamp) = delivery_time_mins AS timeline_consistent
        FROM s_deliveries d WHERE EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = d.order_id AND o.is_delivered)""",
                           text=["pickup_timestamp", "delivered_timestamp"], bigint=["delivery_time_mins"]),
    "sentiment_label": q("""SELECT review_id, rating, CASE WHEN rating >= 4 THEN 'Positive' WHEN rating <= 2
                              THEN 'Negative' ELSE 'Neutral' END AS sentiment_from_rating FROM a_reviews""",
                         bigint=["rating"]),
    "health_score": q("""SELECT restaurant_id, avg_customer_rating, fulfillment_rate_pct, sla_compliance_pct,
                           positive_reviews, negative_reviews, restaurant_health_score FROM g_dim_restaurants"""),
    "null_safe_hash": q("""
        SELECT customer_id,
          sha256(concat_ws(',', """ + ", ".join(
            f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in CUSTOMER_COLS) + """)) AS _hash,
          sha256(concat_ws('||', """ + ", ".join(f"CAST({c} AS VARCHAR)" for c in CUSTOMER_COLS) + """)) AS _row_hash
        FROM (SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id) FROM a_customers)"""),
    "merge_replay": q(f"""
        SELECT * EXCLUDE (marker), marker FROM (
          SELECT *, CASE WHEN l_linenumber < 3 THEN l_linenumber END AS marker FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, marker
          ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in ['l_shipdate', *REPLAY_TIES])}) = 1""",
                      text=["l_shipdate"], bigint=["l_linenumber", "marker"]),
    "bronze_ingest": q("SELECT order_id, sha256(concat_ws('||', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in ORDER_COLS)
                       + f")) AS _row_hash, 'orders' AS source_folder, 'full' AS mode, true AS loaded_at_ok FROM ({ORDER_CONTRACT})"),
    "assert_non_empty": q("\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", CASE WHEN (SELECT count(*) FROM a_{n}) = 0 THEN 'empty' END AS error UNION ALL "
        f"SELECT '{n}_none', 'data quality check failed: {n}_none has 0 records'" for n in ENTITIES)),
    "ri_filter": q("SELECT order_id, customer_id, restaurant_id FROM s_orders"),
    "ddl_tables": q("\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", (SELECT count(*) FROM a_{n}) AS rows, 'parquet' AS provider, true AS has_property, "
        f"'{n} of a layer' AS table_comment, 'tables of one layer' AS database_comment, "
        f"{len(SCHEMAS[n].fields)} AS columns" for n in ENTITIES), bigint=["columns"]),
    "catalog_inventory": q("\nUNION ALL ".join(
        f"SELECT '{n}' AS \"table\", '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS data_type, "
        f"{str(f.nullable).lower()} AS nullable, '{'' if f.nullable else 'required'}' AS comment, "
        f"(SELECT count({f.name}) FROM a_{n}) AS non_null_rows" for n in ENTITIES for f in SCHEMAS[n].fields)),
    "global_ranks": f"""
        WITH t AS (
          SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS word,
            CASE WHEN o_orderkey % 11 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 13 <> 0 THEN o_totalprice END AS price,
            CASE WHEN o_orderkey % 3 = 0 THEN -9223372036854775808 ELSE o_custkey END AS cust FROM orders)
        SELECT o_orderkey, rank() OVER (ORDER BY day ASC NULLS FIRST) AS day_asc, rank() OVER (ORDER BY day DESC NULLS LAST) AS day_desc,
          dense_rank() OVER (ORDER BY word ASC NULLS LAST) AS word_asc, dense_rank() OVER (ORDER BY word DESC NULLS LAST) AS word_desc,
          row_number() OVER (ORDER BY price ASC NULLS FIRST, o_orderkey) AS price_asc,
          row_number() OVER (ORDER BY price DESC NULLS FIRST, o_orderkey) AS price_desc,
          ntile(5) OVER (ORDER BY cust ASC NULLS FIRST, o_orderkey) AS cust_asc, ntile(5) OVER (ORDER BY cust DESC NULLS LAST, o_orderkey) AS cust_desc
        FROM t""",
}
OPS_SQL["ctas_managed"] = OPS_SQL["ctas_aggregate"]
