"""DuckDB SQL for the registered queries (same semantics, written independently).

Conventions that make two engines agree value by value:

* money is summed as DECIMAL(18,2) and averaged from that sum;
* a double is rounded half-up on its shortest decimal text, as Spark does
  (DuckDB's own round works on the binary value);
* timestamps, dates and lists are returned as text, integers as BIGINT.
"""

from __future__ import annotations

AS_OF = "2002-01-01"


def ic(x: str) -> str:
    """Spark ``initcap``: lower-case, then title-case the first letter after each space
    (Java title-cases a leading sharp s as "Ss"; DuckDB's upper gives the capital sharp s)."""
    first = "CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END"
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: {first} || w[2:]), ' ')"


def std(x: str) -> str:
    return ic(f"trim({x})")


def rnd(x: str, s: int) -> str:
    """Spark's ``round`` of a double: half-up on the double's shortest decimal text."""
    return f"CAST(round(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,16)), {s}) AS DOUBLE)"


def msum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def xavg(x: str, in_s: int = 2, out_s: int = 2) -> str:
    """Exact average of values with ``in_s`` decimals, rounded half away from zero
    to ``out_s`` decimals (integer arithmetic on the scaled sum)."""
    k = f"(CAST(sum(CAST({x} AS DECIMAL(20,{in_s}))) * {10 ** in_s} AS HUGEINT) * {10 ** (out_s - in_s)})"
    n = f"NULLIF(count({x}), 0)"
    units = f"(CASE WHEN {k} >= 0 THEN (2 * {k} + {n}) // (2 * {n}) ELSE -((2 * (-{k}) + {n}) // (2 * {n})) END)"
    return f"(CAST({units} AS DOUBLE) / {10 ** out_s})"


def cnt_if(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


def case(x: str, rules: list[tuple[str, str]], other: str) -> str:
    body = " ".join(f"WHEN {x} {cond} THEN '{label}'" for cond, label in rules)
    return f"CASE {body} ELSE '{other}' END"


def dedup(src: str, keys: list[str], order: list[str]) -> str:
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"SELECT * FROM {src} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {o}) = 1"


def present(inner: str, text: list[str] = (), bigint: list[str] = (), exclude: list[str] = ()) -> str:
    rep = [f"CAST({c} AS VARCHAR) AS {c}" for c in text] + [f"CAST({c} AS BIGINT) AS {c}" for c in bigint]
    ex = f" EXCLUDE ({', '.join(exclude)})" if exclude else ""
    r = f" REPLACE ({', '.join(rep)})" if rep else ""
    return f"SELECT *{ex}{r} FROM ({inner}) q"


LINE_COLS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_linestatus"]
CUST_COLS = ["first_name", "last_name", "email", "phone", "city", "locality", "pincode", "latitude",
             "longitude", "signup_date", "subscription_tier", "is_active", "preferred_payment",
             "preferred_cuisine", "total_orders_lifetime", "avg_order_value", "_ingested_at", "_source_system"]

# ----------------------------------------------------------------- adapters
ADAPTERS = f"""
a_lines AS ({dedup('lineitem', ['l_orderkey', 'l_linenumber'], ['l_shipdate'] + LINE_COLS)}),
a_first_order AS (SELECT o_custkey AS c_custkey, min(o_orderdate) AS first_order_date FROM orders GROUP BY o_custkey),
a_customers AS (
  SELECT c.c_custkey AS customer_id,
    split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name,
    lower(replace(c_name, '#', '')) || '@' || lower(c_mktsegment)
      || CASE WHEN c_acctbal < 0 THEN '.co.in' ELSE '.com' END AS email,
    '+' || CAST(c_nationkey + 10 AS VARCHAR) || '-' || CAST(c.c_custkey AS VARCHAR) AS phone,
    ' ' || n_name AS city, r_name AS locality, CAST(c_nationkey AS VARCHAR) AS pincode,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    strftime(first_order_date, '%Y-%m-%dT%H:%M:%S') AS signup_date,
    r_name AS subscription_tier, c_acctbal >= 0 AS is_active,
    CAST(NULL AS VARCHAR) AS preferred_payment, CAST(NULL AS VARCHAR) AS preferred_cuisine,
    CAST(floor(c_acctbal / 50) AS INTEGER) AS total_orders_lifetime,
    c_acctbal AS avg_order_value,
    CAST(NULL AS VARCHAR) AS _ingested_at, 'tpch' AS _source_system
  FROM customer c
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN a_first_order f ON c.c_custkey = f.c_custkey),
a_cuisines AS (
  SELECT l_suppkey AS s_suppkey, list_sort(list(DISTINCT p_type)) AS cuisines
  FROM (SELECT l_suppkey, p_type, sum(l_quantity) AS qty,
               avg(sum(l_quantity)) OVER (PARTITION BY l_suppkey) AS avg_qty
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_type)
  WHERE qty >= avg_qty
  GROUP BY l_suppkey),
a_restaurants AS (
  SELECT s.s_suppkey AS restaurant_id, lower(s_name) AS name, n_name AS city, r_name AS locality,
    CAST(NULL AS VARCHAR) AS address, CAST(s_nationkey AS VARCHAR) AS pincode,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    cu.cuisines, r_name AS restaurant_type,
    CAST(floor(s_acctbal / 5) AS INTEGER) AS avg_cost_for_two,
    CAST(s.s_suppkey % 26 + 25 AS DOUBLE) / 10 AS rating,
    CAST(NULL AS INTEGER) AS total_reviews,
    s_acctbal > 0 AS is_delivering_now, CAST(NULL AS BOOLEAN) AS has_online_delivery,
    CAST(NULL AS BOOLEAN) AS has_table_booking, CAST(NULL AS BOOLEAN) AS is_premium_partner,
    CAST(NULL AS VARCHAR) AS onboarded_date, CAST(NULL AS VARCHAR) AS owner_name,
    CAST(NULL AS VARCHAR) AS owner_phone, CAST(NULL AS VARCHAR) AS gst_number,
    CAST(NULL AS VARCHAR) AS _ingested_at, 'tpch' AS _source_system
  FROM supplier s
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN a_cuisines cu ON s.s_suppkey = cu.s_suppkey),
a_totals AS (
  SELECT l_orderkey, min(l_suppkey) AS restaurant_id,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS subtotal,
    max(l_discount) AS max_discount,
    sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS discount_amount,
    sum(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
        * CAST(l_tax AS DECIMAL(4,2))) AS tax_amount,
    count(*) AS num_items
  FROM a_lines GROUP BY l_orderkey),
a_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, t.restaurant_id,
    strftime(o_orderdate + to_seconds(CAST(round(o_totalprice * 100) AS BIGINT) % 86400),
             '%Y-%m-%dT%H:%M:%S') AS order_placed_at,
    CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Placed' WHEN 'P' THEN 'Cancelled' END AS order_status,
    o_orderpriority AS payment_method,
    CASE WHEN o_orderstatus = 'F' THEN 'paid' WHEN o_orderstatus = 'P' THEN 'refunded' ELSE 'pending' END AS payment_status,
    c_mktsegment AS platform,
    CAST(t.subtotal AS DOUBLE) AS subtotal,
    t.max_discount * 100 AS discount_pct,
    CAST(t.discount_amount AS DOUBLE) AS discount_amount,
    CAST(NULL AS VARCHAR) AS coupon_code,
    CAST(t.num_items * 5 AS DOUBLE) AS delivery_fee,
    CAST(t.tax_amount AS DOUBLE) AS tax_amount,
    o_totalprice AS total_amount,
    CAST(t.num_items AS INTEGER) AS num_items,
    CAST(NULL AS VARCHAR) AS special_instructions,
    CAST(NULL AS VARCHAR) AS _ingested_at, 'tpch' AS _source_system
  FROM orders
  LEFT JOIN a_totals t ON o_orderkey = t.l_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey),
a_deliveries AS (
  SELECT l_orderkey * 10 + l_linenumber AS delivery_id, l_orderkey AS order_id,
    CAST(l_suppkey AS VARCHAR) AS delivery_partner_id,
    CAST(NULL AS VARCHAR) AS delivery_partner_name, CAST(NULL AS VARCHAR) AS partner_phone,
    lower(l_returnflag) AS vehicle_type,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS pickup_timestamp,
    strftime(l_shipdate + to_minutes(CAST(l_quantity AS INTEGER)), '%Y-%m-%dT%H:%M:%S') AS delivered_timestamp,
    CAST(l_quantity AS INTEGER) AS delivery_time_mins,
    l_linestatus AS delivery_status,
    CAST(CAST(l_discount AS DECIMAL(4,2)) * 150 AS DOUBLE) AS delivery_distance_km,
    CAST(l_partkey % 7 + 1 AS INTEGER) AS delivery_rating,
    CAST(NULL AS VARCHAR) AS _ingested_at, 'tpch' AS _source_system
  FROM a_lines),
a_reviews AS (
  SELECT event_id AS review_id, CAST(NULL AS BIGINT) AS order_id, user_id AS customer_id,
    event_id % (SELECT count(*) FROM supplier) AS restaurant_id,
    CAST(floor(value) AS INTEGER) % 7 AS rating,
    ' ' || event_type || ' ' || props || ' ' AS review_text,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS review_timestamp,
    CASE WHEN CAST(floor(value) AS INTEGER) % 7 >= 4 THEN ' positive'
         WHEN CAST(floor(value) AS INTEGER) % 7 <= 2 THEN 'negative ' ELSE 'neutral' END AS sentiment_label,
    event_type = 'purchase' AS is_verified_order,
    CAST(NULL AS INTEGER) AS upvotes, CAST(NULL AS BOOLEAN) AS has_photo,
    CAST(NULL AS VARCHAR) AS _ingested_at, 'tpch' AS _source_system
  FROM events)"""

# ------------------------------------------------------------------- silver
SEGMENT = case("total_orders_lifetime", [(">= 100", "Power User"), (">= 30", "Regular"), (">= 5", "Occasional")], "New")
PRICE = case("avg_cost_for_two", [("<= 300", "Budget"), ("<= 700", "Mid-Range"), ("<= 1500", "Premium")], "Luxury")
RTIER = case("rating", [(">= 4.5", "Excellent"), (">= 4.0", "Very Good"), (">= 3.5", "Good"), (">= 3.0", "Average")],
             "Below Average")
SLOT = case("order_hour", [("BETWEEN 6 AND 10", "Breakfast"), ("BETWEEN 11 AND 14", "Lunch"),
                           ("BETWEEN 15 AND 17", "Snacks"), ("BETWEEN 18 AND 22", "Dinner")], "Late Night")
SLA = case("delivery_time_mins", [("<= 30", "Within SLA"), ("<= 45", "Near SLA")], "SLA Breached")
DIST = case("delivery_distance_km", [("<= 3", "Short (0-3 km)"), ("<= 7", "Medium (3-7 km)"),
                                     ("<= 12", "Long (7-12 km)")], "Very Long (12+ km)")
RFM = case("rfm_score", [(">= 13", "Champions"), (">= 10", "Loyal Customers"), (">= 7", "Potential Loyalists"),
                         (">= 4", "At Risk")], "Churned")
EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z]{2,}$"

SILVER = f"""
s_cust_0 AS ({dedup('a_customers', ['customer_id'], CUST_COLS)}),
s_cust_1 AS (
  SELECT * EXCLUDE (_ingested_at, _source_system) REPLACE (
      {std('first_name')} AS first_name, {std('last_name')} AS last_name,
      lower(trim(email)) AS email,
      try_cast(signup_date AS TIMESTAMP) AS signup_date,
      {std('city')} AS city,
      coalesce(subscription_tier, 'Free') AS subscription_tier,
      coalesce(is_active, true) AS is_active,
      coalesce(total_orders_lifetime, 0) AS total_orders_lifetime,
      coalesce(avg_order_value, 0.0) AS avg_order_value),
    regexp_replace(phone, '[^0-9+]', '', 'g') AS phone_cleaned,
    CAST(subscription_tier IS NULL AS INTEGER) + CAST(is_active IS NULL AS INTEGER)
      + CAST(total_orders_lifetime IS NULL AS INTEGER) + CAST(avg_order_value IS NULL AS INTEGER) AS _nulls_filled
  FROM s_cust_0),
s_customers_all AS (
  SELECT *, concat_ws(' ', first_name, last_name) AS full_name,
    year(signup_date) AS signup_year, month(signup_date) AS signup_month,
    {SEGMENT} AS customer_segment,
    round(1.0::DOUBLE - _nulls_filled::DOUBLE / 4.0::DOUBLE, 2) AS _data_quality_score,
    CASE WHEN customer_id IS NULL THEN 'null_customer_id' WHEN email IS NULL THEN 'null_email'
         WHEN NOT regexp_matches(email, '{EMAIL}') THEN 'invalid_email' END AS _reject_reason
  FROM s_cust_1),
s_customers AS (SELECT * EXCLUDE (_nulls_filled, _reject_reason) FROM s_customers_all WHERE _reject_reason IS NULL),
s_rest_0 AS (SELECT * FROM a_restaurants QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY name DESC NULLS LAST) = 1),
s_restaurants AS (
  SELECT * EXCLUDE (_ingested_at, _source_system) REPLACE (
      {std('name')} AS name, {std('city')} AS city, {std('locality')} AS locality,
      try_cast(onboarded_date AS TIMESTAMP) AS onboarded_date,
      {rnd('rating', 1)} AS rating,
      coalesce(is_delivering_now, false) AS is_delivering_now,
      coalesce(has_online_delivery, false) AS has_online_delivery,
      coalesce(has_table_booking, false) AS has_table_booking,
      coalesce(is_premium_partner, false) AS is_premium_partner),
    coalesce(array_to_string(cuisines, ', '), '') AS cuisines_list,
    len(cuisines) AS num_cuisines,
    {PRICE} AS price_tier,
    {RTIER} AS rating_tier
  FROM s_rest_0
  WHERE restaurant_id IS NOT NULL AND {std('name')} IS NOT NULL),
s_ord_0 AS (SELECT * FROM a_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id DESC NULLS LAST) = 1),
s_ord_1 AS (
  SELECT * EXCLUDE (_ingested_at, _source_system) REPLACE (
      try_cast(order_placed_at AS TIMESTAMP) AS order_placed_at,
      upper(trim(order_status)) AS order_status,
      upper(trim(payment_status)) AS payment_status,
      CASE WHEN total_amount < 0 THEN 0.0 ELSE total_amount END AS total_amount)
  FROM s_ord_0),
s_ord_2 AS (
  SELECT * REPLACE (
      {rnd('subtotal', 2)} AS subtotal, {rnd('total_amount', 2)} AS total_amount,
      {rnd('discount_amount', 2)} AS discount_amount, {rnd('tax_amount', 2)} AS tax_amount,
      {rnd('delivery_fee', 2)} AS delivery_fee),
    CAST(order_placed_at AS DATE) AS order_date,
    year(order_placed_at) AS order_year, month(order_placed_at) AS order_month,
    dayofweek(order_placed_at) + 1 AS order_day_of_week, hour(order_placed_at) AS order_hour,
    strftime(order_placed_at, '%A') AS order_day_name,
    coalesce(order_status IN ('DELIVERED'), false) AS is_delivered,
    coalesce(order_status IN ('CANCELLED', 'REFUNDED'), false) AS is_cancelled,
    coalesce(discount_pct > 0, false) AS has_discount
  FROM s_ord_1),
s_orders_conformed AS (SELECT *, {SLOT} AS order_time_slot FROM s_ord_2),
s_orders AS (
  SELECT * FROM s_orders_conformed o
  WHERE EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = o.customer_id)
    AND EXISTS (SELECT 1 FROM s_restaurants r WHERE r.restaurant_id = o.restaurant_id)),
s_orders_rejected AS (
  SELECT o.*, CASE
      WHEN NOT EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = o.customer_id) THEN 'unknown_customer_id'
      ELSE 'unknown_restaurant_id' END AS _reject_reason
  FROM s_orders_conformed o
  WHERE NOT EXISTS (SELECT 1 FROM s_customers c WHERE c.customer_id = o.customer_id)
     OR NOT EXISTS (SELECT 1 FROM s_restaurants r WHERE r.restaurant_id = o.restaurant_id)),
s_del_0 AS (SELECT * FROM a_deliveries QUALIFY row_number() OVER (PARTITION BY delivery_id ORDER BY order_id DESC NULLS LAST) = 1),
s_deliveries_conformed AS (
  SELECT * EXCLUDE (_ingested_at, _source_system) REPLACE (
      try_cast(pickup_timestamp AS TIMESTAMP) AS pickup_timestamp,
      try_cast(delivered_timestamp AS TIMESTAMP) AS delivered_timestamp,
      upper(trim(delivery_status)) AS delivery_status,
      {std('vehicle_type')} AS vehicle_type,
      CASE WHEN delivery_rating BETWEEN 1 AND 5 THEN delivery_rating END AS delivery_rating,
      {rnd('delivery_distance_km', 2)} AS delivery_distance_km),
    {SLA} AS delivery_sla_status,
    {DIST} AS distance_bucket
  FROM s_del_0),
s_deliveries AS (
  SELECT * FROM s_deliveries_conformed d
  WHERE EXISTS (SELECT 1 FROM s_orders o WHERE o.order_id = d.order_id)),
s_rev_0 AS (SELECT * FROM a_reviews QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY customer_id DESC NULLS LAST) = 1),
s_rev_1 AS (
  SELECT * EXCLUDE (_ingested_at, _source_system) REPLACE (
      try_cast(review_timestamp AS TIMESTAMP) AS review_timestamp,
      CASE WHEN rating BETWEEN 1 AND 5 THEN rating END AS rating,
      trim(review_text) AS review_text,
      {std('sentiment_label')} AS sentiment_label)
  FROM s_rev_0),
s_reviews AS (
  SELECT *, CAST(review_timestamp AS DATE) AS review_date,
    coalesce(length(review_text), 0) AS review_text_length
  FROM s_rev_1 WHERE review_id IS NOT NULL AND rating IS NOT NULL)"""

# --------------------------------------------------------------------- gold
GOLD = f"""
g_com AS (
  SELECT customer_id, count(order_id) AS total_orders,
    {cnt_if('is_delivered')} AS delivered_orders, {cnt_if('is_cancelled')} AS cancelled_orders,
    {msum('total_amount')} AS lifetime_revenue, {xavg('total_amount')} AS avg_order_value,
    min(order_placed_at) AS first_order_at, max(order_placed_at) AS last_order_at,
    count(DISTINCT restaurant_id) AS unique_restaurants, count(DISTINCT order_date) AS distinct_order_days,
    {msum('discount_amount')} AS total_discount_availed
  FROM s_orders GROUP BY customer_id),
g_crm AS (
  SELECT customer_id, count(review_id) AS total_reviews, avg(rating) AS avg_rating_given
  FROM s_reviews GROUP BY customer_id),
g_cbase AS (
  SELECT c.* EXCLUDE (avg_order_value),
    m.delivered_orders, m.cancelled_orders, m.first_order_at, m.last_order_at,
    m.unique_restaurants, m.distinct_order_days, r.total_reviews, r.avg_rating_given,
    coalesce(m.total_orders, 0) AS total_orders,
    {rnd('coalesce(m.lifetime_revenue, 0.0)', 2)} AS lifetime_revenue,
    {rnd('coalesce(m.avg_order_value, 0.0)', 2)} AS avg_order_value,
    {rnd('coalesce(m.total_discount_availed, 0.0)', 2)} AS total_discount_availed,
    date_diff('day', CAST(m.last_order_at AS DATE), DATE '{AS_OF}') AS days_since_last_order,
    {rnd('coalesce(m.cancelled_orders, 0) / CASE WHEN m.total_orders > 0 THEN m.total_orders ELSE 1 END * 100', 2)}
      AS cancel_rate_pct
  FROM s_customers c
  LEFT JOIN g_com m ON c.customer_id = m.customer_id
  LEFT JOIN g_crm r ON c.customer_id = r.customer_id),
g_rfm AS (
  SELECT *,
    ntile(5) OVER (ORDER BY days_since_last_order ASC NULLS LAST, customer_id) AS recency_score,
    ntile(5) OVER (ORDER BY total_orders DESC NULLS LAST, customer_id) AS frequency_score,
    ntile(5) OVER (ORDER BY lifetime_revenue DESC NULLS LAST, customer_id) AS monetary_score
  FROM g_cbase),
g_dim_customers AS (
  SELECT *, recency_score + frequency_score + monetary_score AS rfm_score,
    {RFM.replace('rfm_score', '(recency_score + frequency_score + monetary_score)')} AS rfm_segment
  FROM g_rfm),
g_rom AS (
  SELECT restaurant_id, count(order_id) AS total_orders_received,
    {cnt_if('is_delivered')} AS total_delivered, {cnt_if('is_cancelled')} AS total_cancelled,
    {msum('total_amount')} AS total_gmv, {xavg('total_amount')} AS avg_order_value,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT order_date) AS active_days
  FROM s_orders GROUP BY restaurant_id),
g_rrm AS (
  SELECT restaurant_id, count(review_id) AS review_count, avg(rating) AS avg_customer_rating,
    {cnt_if("sentiment_label = 'Positive'")} AS positive_reviews,
    {cnt_if("sentiment_label = 'Negative'")} AS negative_reviews
  FROM s_reviews GROUP BY restaurant_id),
g_rdm AS (
  SELECT o.restaurant_id, avg(d.delivery_time_mins) AS avg_delivery_time_mins,
    {cnt_if("d.delivery_sla_status = 'Within SLA'")} AS sla_met_count,
    count(d.delivery_id) AS total_delivery_count
  FROM s_deliveries d JOIN s_orders o ON d.order_id = o.order_id
  GROUP BY o.restaurant_id),
g_r1 AS (
  SELECT r.*,
    om.total_orders_received, om.total_delivered, om.total_cancelled, om.unique_customers, om.active_days,
    rm.review_count, rm.positive_reviews, rm.negative_reviews,
    dm.sla_met_count, dm.total_delivery_count,
    {rnd('coalesce(om.total_gmv, 0.0)', 2)} AS total_gmv,
    {rnd('coalesce(om.avg_order_value, 0.0)', 2)} AS avg_order_value,
    {rnd('coalesce(rm.avg_customer_rating, 0.0)', 1)} AS avg_customer_rating,
    {rnd('coalesce(dm.avg_delivery_time_mins, 0.0)', 1)} AS avg_delivery_time_mins,
    {rnd('coalesce(om.total_delivered, 0) / CASE WHEN om.total_orders_received > 0 THEN om.total_orders_received ELSE 1 END * 100', 2)} AS fulfillment_rate_pct,
    {rnd('coalesce(dm.sla_met_count, 0) / CASE WHEN dm.total_delivery_count > 0 THEN dm.total_delivery_count ELSE 1 END * 100', 2)} AS sla_compliance_pct
  FROM s_restaurants r
  LEFT JOIN g_rom om ON r.restaurant_id = om.restaurant_id
  LEFT JOIN g_rrm rm ON r.restaurant_id = rm.restaurant_id
  LEFT JOIN g_rdm dm ON r.restaurant_id = dm.restaurant_id),
g_dim_restaurants AS (
  SELECT *, {rnd('''coalesce(avg_customer_rating, 0) / 5 * 30 + coalesce(fulfillment_rate_pct, 0) / 100 * 30
      + coalesce(sla_compliance_pct, 0) / 100 * 20
      + CASE WHEN positive_reviews > 0 THEN positive_reviews / (positive_reviews + coalesce(negative_reviews, 1)) * 20
             ELSE 10 END''', 1)} AS restaurant_health_score
  FROM g_r1),
g_first_delivery AS (
  SELECT * FROM s_deliveries QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY delivery_id) = 1),
g_fact AS (
  SELECT o.*, c.full_name, c.city AS customer_city, c.customer_segment, c.subscription_tier,
    r.name AS restaurant_name, r.restaurant_type, r.cuisines_list, r.price_tier, r.rating_tier,
    d.delivery_time_mins, d.delivery_sla_status, d.delivery_distance_km, d.delivery_rating
  FROM s_orders o
  LEFT JOIN s_customers c ON o.customer_id = c.customer_id
  LEFT JOIN s_restaurants r ON o.restaurant_id = r.restaurant_id
  LEFT JOIN g_first_delivery d ON o.order_id = d.order_id),
g_daily AS (
  SELECT customer_city, order_date, order_year, order_month,
    count(order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
    count(DISTINCT restaurant_id) AS active_restaurants,
    {rnd(msum('total_amount'), 2)} AS total_gmv, {xavg('total_amount')} AS avg_order_value,
    {cnt_if('is_delivered')} AS delivered_orders, {cnt_if('is_cancelled')} AS cancelled_orders,
    {rnd('avg(delivery_time_mins)', 1)} AS avg_delivery_time_mins,
    {rnd(msum('discount_amount'), 2)} AS total_discounts,
    {rnd("sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END) / count(order_id) * 100", 2)} AS cancel_rate_pct
  FROM g_fact GROUP BY customer_city, order_date, order_year, order_month),
g_perf_0 AS (
  SELECT restaurant_id, name, city, restaurant_type, price_tier, rating_tier, total_orders_received,
    total_gmv, avg_order_value, unique_customers, avg_customer_rating, avg_delivery_time_mins,
    fulfillment_rate_pct, sla_compliance_pct, restaurant_health_score,
    dense_rank() OVER (PARTITION BY city ORDER BY restaurant_health_score DESC NULLS LAST) AS city_rank,
    dense_rank() OVER (ORDER BY restaurant_health_score DESC NULLS LAST) AS overall_rank,
    percent_rank() OVER (ORDER BY restaurant_health_score DESC NULLS LAST) AS _pr
  FROM g_dim_restaurants),
g_perf AS (
  SELECT * EXCLUDE (_pr), CASE WHEN overall_rank <= 50 THEN 'Top 50' WHEN _pr <= 0.1 THEN 'Top 10%'
      WHEN _pr <= 0.25 THEN 'Top 25%' ELSE 'Standard' END AS performance_tier
  FROM g_perf_0),
g_cohorts AS (
  SELECT strftime(c.signup_date, '%Y-%m') AS cohort_month, strftime(f.order_date, '%Y-%m') AS activity_month,
    count(DISTINCT f.customer_id) AS active_customers, count(*) AS total_orders,
    {rnd(msum('f.total_amount'), 2)} AS cohort_revenue
  FROM g_fact f JOIN g_dim_customers c ON f.customer_id = c.customer_id
  GROUP BY 1, 2),
g_sla AS (
  SELECT r.city, d.vehicle_type, d.delivery_sla_status, count(d.delivery_id) AS delivery_count,
    {rnd('avg(d.delivery_time_mins)', 1)} AS avg_delivery_mins,
    {xavg('d.delivery_distance_km')} AS avg_distance_km,
    {rnd('avg(d.delivery_rating)', 2)} AS avg_delivery_rating
  FROM s_deliveries d
  JOIN s_orders o ON d.order_id = o.order_id
  JOIN s_restaurants r ON o.restaurant_id = r.restaurant_id
  GROUP BY r.city, d.vehicle_type, d.delivery_sla_status),
g_rev_0 AS (
  SELECT order_year, order_month, count(order_id) AS total_orders,
    count(DISTINCT customer_id) AS unique_customers, count(DISTINCT restaurant_id) AS active_restaurants,
    sum(CAST(total_amount AS DECIMAL(18,2))) AS _gmv,
    sum(CAST(subtotal AS DECIMAL(18,2))) AS _subtotal,
    sum(CAST(discount_amount AS DECIMAL(18,2))) AS _discounts,
    {msum('delivery_fee')} AS total_delivery_fees, {msum('tax_amount')} AS total_tax_collected,
    {xavg('total_amount')} AS avg_order_value,
    quantile_disc(total_amount, 0.5) AS median_order_value
  FROM g_fact WHERE is_delivered GROUP BY order_year, order_month),
g_rev_1 AS (
  SELECT * EXCLUDE (_gmv, _subtotal, _discounts),
    CAST(round(_gmv, 2) AS DOUBLE) AS total_gmv,
    CAST(_subtotal AS DOUBLE) AS total_subtotal,
    CAST(_discounts AS DOUBLE) AS total_discounts,
    CAST(round(_subtotal - _discounts, 2) AS DOUBLE) AS net_revenue,
    {rnd('CAST(_discounts AS DOUBLE) / CAST(_gmv AS DOUBLE) * 100', 2)} AS discount_penetration_pct
  FROM g_rev_0),
g_revenue AS (
  SELECT *, {rnd('''(total_gmv - coalesce(lag(total_gmv) OVER w, total_gmv))
      / CASE WHEN lag(total_gmv) OVER w > 0 THEN lag(total_gmv) OVER w ELSE 1 END * 100''', 2)} AS gmv_growth_pct
  FROM g_rev_1 WINDOW w AS (ORDER BY order_year, order_month))"""

CTES = "WITH " + ",".join([ADAPTERS, SILVER, GOLD])


def q(body: str, **kw) -> str:
    return present(f"{CTES}\n{body}", **kw)


CUST_TEXT = ["signup_date"]
CUST_INT = ["total_orders_lifetime", "signup_year", "signup_month"]
ORDER_TEXT = ["order_placed_at", "order_date"]
ORDER_INT = ["num_items", "order_year", "order_month", "order_day_of_week", "order_hour"]
REST_TEXT = ["cuisines", "onboarded_date"]
REST_INT = ["avg_cost_for_two", "total_reviews", "num_cuisines"]
DEL_TEXT = ["pickup_timestamp", "delivered_timestamp"]
DEL_INT = ["delivery_time_mins", "delivery_rating"]

ORACLE_SQL: dict[str, str] = {
    "revenue_summary": q("SELECT * FROM g_revenue", bigint=["order_year", "order_month"]),
    "dedup_latest": q("SELECT * FROM a_lines", text=["l_shipdate"], bigint=["l_linenumber"]),
    "silver_customers": q("SELECT * FROM s_customers", text=CUST_TEXT, bigint=CUST_INT),
    "silver_restaurants": q("SELECT * FROM s_restaurants", text=REST_TEXT, bigint=REST_INT),
    "silver_orders": q("SELECT * FROM s_orders", text=ORDER_TEXT, bigint=ORDER_INT),
    "silver_deliveries": q("SELECT * FROM s_deliveries", text=DEL_TEXT, bigint=DEL_INT),
    "silver_reviews": q("SELECT * FROM s_reviews", text=["review_timestamp", "review_date"],
                        bigint=["rating", "upvotes", "review_text_length"]),
    "ri_quarantine": q("SELECT order_id, customer_id, restaurant_id, _reject_reason FROM s_orders_rejected"),
    "customer_order_metrics": q("SELECT * FROM g_com", text=["first_order_at", "last_order_at"]),
    "dim_customers": q("SELECT * FROM g_dim_customers",
                       text=CUST_TEXT + ["first_order_at", "last_order_at"],
                       bigint=CUST_INT + ["total_orders", "days_since_last_order", "recency_score",
                                          "frequency_score", "monetary_score", "rfm_score"]),
    "rfm_scores": q("""SELECT customer_id, days_since_last_order, total_orders, lifetime_revenue, recency_score,
                         frequency_score, monetary_score, rfm_score, rfm_segment FROM g_dim_customers""",
                    bigint=["total_orders", "days_since_last_order", "recency_score", "frequency_score",
                            "monetary_score", "rfm_score"]),
    "dim_restaurants": q("SELECT * FROM g_dim_restaurants",
                         text=REST_TEXT, bigint=REST_INT),
    "fact_orders": q("SELECT * FROM g_fact", text=ORDER_TEXT, bigint=ORDER_INT + DEL_INT),
    "daily_city_metrics": q("SELECT * FROM g_daily", text=["order_date"], bigint=["order_year", "order_month"]),
    "restaurant_performance": q("SELECT * FROM g_perf", bigint=["city_rank", "overall_rank"]),
    "customer_cohorts": q("SELECT * FROM g_cohorts"),
    "delivery_sla_report": q("SELECT * FROM g_sla"),
    # dashboard
    "headline_kpis": q(f"""
        SELECT count(*) AS total_orders,
          coalesce({msum('total_amount')}, 0.0) AS total_gmv,
          (SELECT count(*) FROM g_dim_customers) AS total_customers,
          (SELECT count(*) FROM g_dim_restaurants) AS total_restaurants,
          coalesce({xavg('total_amount')}, 0.0) AS avg_order_value,
          {rnd("coalesce(sum(CASE WHEN is_delivered THEN 1 ELSE 0 END), 0) / greatest(count(*), 1) * 100", 2)} AS delivery_rate_pct,
          {rnd("coalesce(sum(CASE WHEN is_cancelled THEN 1 ELSE 0 END), 0) / greatest(count(*), 1) * 100", 2)} AS cancel_rate_pct
        FROM g_fact"""),
    "revenue_trend": q("""SELECT order_year, order_month, total_orders, total_gmv, avg_order_value, unique_customers,
                            net_revenue, total_discounts, discount_penetration_pct FROM g_revenue""",
                       bigint=["order_year", "order_month"]),
    "payment_breakdown": q(f"""
        SELECT payment_method, count(order_id) AS order_count,
          {rnd(msum('total_amount'), 2)} AS total_revenue, {xavg('total_amount')} AS avg_value,
          {rnd(f"{rnd(msum('total_amount'), 2)} / (SELECT coalesce({msum('total_amount')}, 0.0) FROM g_fact) * 100", 2)} AS share_pct
        FROM g_fact WHERE is_delivered GROUP BY payment_method"""),
    "platform_breakdown": q(f"""
        SELECT platform, count(order_id) AS order_count, {rnd(msum('total_amount'), 2)} AS total_revenue,
          count(DISTINCT customer_id) AS unique_users
        FROM g_fact WHERE is_delivered GROUP BY platform"""),
    "city_performance": q(f"""
        SELECT customer_city, sum(total_orders) AS total_orders, {rnd(msum('total_gmv'), 2)} AS total_gmv,
          sum(unique_customers) AS total_unique_customers, {xavg('avg_order_value')} AS avg_aov,
          {xavg('avg_delivery_time_mins', 1, 1)} AS avg_delivery_time,
          {xavg('cancel_rate_pct')} AS avg_cancel_rate
        FROM g_daily GROUP BY customer_city""", bigint=["total_orders", "total_unique_customers"]),
    "city_trend": q(f"""
        SELECT customer_city, order_year, order_month, sum(total_orders) AS monthly_orders,
          {rnd(msum('total_gmv'), 2)} AS monthly_gmv
        FROM g_daily GROUP BY customer_city, order_year, order_month""",
                    bigint=["order_year", "order_month", "monthly_orders"]),
    "top_restaurants": q("""
        SELECT overall_rank, name, city, restaurant_type, total_orders_received, total_gmv, avg_customer_rating,
          avg_delivery_time_mins, fulfillment_rate_pct, sla_compliance_pct, restaurant_health_score,
          performance_tier
        FROM g_perf WHERE total_orders_received >= 50
        ORDER BY restaurant_health_score DESC, restaurant_id LIMIT 20""", bigint=["overall_rank"]),
    "type_distribution": q(f"""
        SELECT restaurant_type, price_tier, count(restaurant_id) AS count, {xavg('total_gmv')} AS avg_gmv,
          {xavg('avg_customer_rating', 1, 2)} AS avg_rating
        FROM g_dim_restaurants GROUP BY restaurant_type, price_tier"""),
    "rfm_distribution": q(f"""
        SELECT rfm_segment, count(customer_id) AS customer_count, {xavg('lifetime_revenue')} AS avg_ltv,
          {rnd('avg(total_orders)', 1)} AS avg_orders, {rnd('avg(days_since_last_order)', 0)} AS avg_recency_days,
          {rnd('count(customer_id) / (SELECT count(*) FROM g_dim_customers) * 100', 2)} AS pct_of_total
        FROM g_dim_customers GROUP BY rfm_segment"""),
    "segment_by_tier": q(f"""
        SELECT customer_segment, subscription_tier, count(customer_id) AS count,
          {xavg('lifetime_revenue')} AS avg_revenue
        FROM g_dim_customers GROUP BY customer_segment, subscription_tier"""),
    "cohort_listing": q("""SELECT cohort_month, activity_month, active_customers, total_orders, cohort_revenue
                           FROM g_cohorts"""),
    "sla_overview": q(f"""
        SELECT delivery_sla_status, sum(delivery_count) AS total_deliveries,
          {xavg('avg_delivery_mins', 1, 1)} AS avg_time_mins, {xavg('avg_delivery_rating')} AS avg_rating
        FROM g_sla GROUP BY delivery_sla_status""", bigint=["total_deliveries"]),
    "sla_by_city": q(f"""
        SELECT city, sum(delivery_count) AS total_deliveries, {xavg('avg_delivery_mins', 1, 1)} AS avg_delivery_mins,
          {xavg('avg_distance_km')} AS avg_distance, {xavg('avg_delivery_rating')} AS avg_rating
        FROM g_sla GROUP BY city""", bigint=["total_deliveries"]),
    "sla_by_vehicle": q(f"""
        SELECT vehicle_type, sum(delivery_count) AS total_deliveries,
          {xavg('avg_delivery_mins', 1, 1)} AS avg_time, {xavg('avg_distance_km')} AS avg_distance
        FROM g_sla GROUP BY vehicle_type""", bigint=["total_deliveries"]),
    "cuisine_revenue": q(f"""
        SELECT cuisine, count(order_id) AS order_count, {rnd(msum('total_amount'), 2)} AS total_revenue,
          {xavg('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
        FROM (SELECT trim(unnest(string_split(cuisines_list, ','))) AS cuisine, order_id, total_amount, customer_id
              FROM g_fact WHERE is_delivered)
        GROUP BY cuisine ORDER BY total_revenue DESC, cuisine LIMIT 20"""),
    "time_slot_analysis": q(f"""
        SELECT order_time_slot, count(order_id) AS order_count, {rnd(msum('total_amount'), 2)} AS total_gmv,
          {xavg('total_amount')} AS avg_order_value, count(DISTINCT customer_id) AS unique_customers
        FROM g_fact GROUP BY order_time_slot"""),
    "high_cancel_restaurants": q(f"""
        SELECT * FROM (
          SELECT restaurant_id, name, city, total_orders_received,
            {rnd('coalesce(total_cancelled, 0) / total_orders_received * 100', 2)} AS cancel_rate,
            restaurant_health_score
          FROM g_dim_restaurants WHERE total_orders_received >= 20)
        WHERE cancel_rate > 15"""),
    "churn_risk": q("""
        SELECT customer_id, full_name, city, customer_segment, rfm_segment, total_orders, lifetime_revenue,
          days_since_last_order, cancel_rate_pct
        FROM g_dim_customers
        WHERE rfm_segment IN ('At Risk', 'Churned') AND lifetime_revenue > 1000
        ORDER BY lifetime_revenue DESC, customer_id LIMIT 50""", bigint=["total_orders", "days_since_last_order"]),
    "churn_count": q("SELECT count(*) AS churn_count FROM g_dim_customers WHERE rfm_segment IN ('At Risk', 'Churned')"),
}
