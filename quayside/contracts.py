"""Entity contracts, bucket rules and quality thresholds.

Everything in this module is a fixed value: the column contracts of the five
marketplace entities, the CASE bucket rules used by the silver and gold layers
and the quality thresholds. They are data, not logic, and are kept together so
that one place states what the rest of the package must agree on.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, B, F = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType(), T.FloatType()


def _schema(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- Fixed values: landing-file contracts (key columns are declared NOT NULL) ---
CUSTOMERS = _schema(
    ("customer_id", S, False), ("first_name", S, True), ("last_name", S, True),
    ("email", S, True), ("phone", S, True), ("city", S, True), ("locality", S, True),
    ("pincode", S, True), ("latitude", D, True), ("longitude", D, True),
    ("signup_date", S, True), ("subscription_tier", S, True), ("is_active", B, True),
    ("preferred_payment", S, True), ("preferred_cuisine", S, True),
    ("total_orders_lifetime", I, True), ("avg_order_value", D, True),
    ("_ingested_at", S, True), ("_source_system", S, True),
)

RESTAURANTS = _schema(
    ("restaurant_id", S, False), ("name", S, True), ("city", S, True), ("locality", S, True),
    ("address", S, True), ("pincode", S, True), ("latitude", D, True), ("longitude", D, True),
    ("cuisines", T.ArrayType(S), True), ("restaurant_type", S, True),
    ("avg_cost_for_two", I, True), ("rating", F, True), ("total_reviews", I, True),
    ("is_delivering_now", B, True), ("has_online_delivery", B, True),
    ("has_table_booking", B, True), ("is_premium_partner", B, True),
    ("onboarded_date", S, True), ("owner_name", S, True), ("owner_phone", S, True),
    ("gst_number", S, True), ("_ingested_at", S, True), ("_source_system", S, True),
)

ORDERS = _schema(
    ("order_id", S, False), ("customer_id", S, True), ("restaurant_id", S, True),
    ("order_placed_at", S, True), ("order_status", S, True), ("payment_method", S, True),
    ("payment_status", S, True), ("platform", S, True), ("subtotal", D, True),
    ("discount_pct", D, True), ("discount_amount", D, True), ("coupon_code", S, True),
    ("delivery_fee", D, True), ("tax_amount", D, True), ("total_amount", D, True),
    ("num_items", I, True), ("special_instructions", S, True),
    ("_ingested_at", S, True), ("_source_system", S, True),
)

DELIVERIES = _schema(
    ("delivery_id", S, False), ("order_id", S, True), ("delivery_partner_id", S, True),
    ("delivery_partner_name", S, True), ("partner_phone", S, True), ("vehicle_type", S, True),
    ("pickup_timestamp", S, True), ("delivered_timestamp", S, True),
    ("delivery_time_mins", I, True), ("delivery_status", S, True),
    ("delivery_distance_km", D, True), ("delivery_rating", I, True),
    ("_ingested_at", S, True), ("_source_system", S, True),
)

REVIEWS = _schema(
    ("review_id", S, False), ("order_id", S, True), ("customer_id", S, True),
    ("restaurant_id", S, True), ("rating", I, True), ("review_text", S, True),
    ("review_timestamp", S, True), ("sentiment_label", S, True),
    ("is_verified_order", B, True), ("upvotes", I, True), ("has_photo", B, True),
    ("_ingested_at", S, True), ("_source_system", S, True),
)

SCHEMAS: dict[str, T.StructType] = {
    "customers": CUSTOMERS,
    "restaurants": RESTAURANTS,
    "orders": ORDERS,
    "deliveries": DELIVERIES,
    "reviews": REVIEWS,
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "customers": ["customer_id"],
    "restaurants": ["restaurant_id"],
    "orders": ["order_id"],
    "deliveries": ["delivery_id"],
    "reviews": ["review_id"],
}

# Technical columns: source side, added by bronze, added by silver / gold.
SOURCE_TECH = ["_ingested_at", "_source_system"]
BRONZE_TECH = ["_bronze_loaded_at", "_source_file", "_row_hash"]
SILVER_DROP = SOURCE_TECH + ["_source_file", "_row_hash", "_bronze_loaded_at"]

# --- Fixed values: CASE bucket rules (first match wins; NULL falls to the else label) ---
# Each rule is (operator, bound, label); operator is one of ">=", "<=", "between".
CUSTOMER_SEGMENT = ([(">=", 100, "Power User"), (">=", 30, "Regular"), (">=", 5, "Occasional")], "New")
PRICE_TIER = ([("<=", 300, "Budget"), ("<=", 700, "Mid-Range"), ("<=", 1500, "Premium")], "Luxury")
RATING_TIER = (
    [(">=", 4.5, "Excellent"), (">=", 4.0, "Very Good"), (">=", 3.5, "Good"), (">=", 3.0, "Average")],
    "Below Average",
)
ORDER_TIME_SLOT = (
    [("between", (6, 10), "Breakfast"), ("between", (11, 14), "Lunch"),
     ("between", (15, 17), "Snacks"), ("between", (18, 22), "Dinner")],
    "Late Night",
)
DELIVERY_SLA_STATUS = ([("<=", 30, "Within SLA"), ("<=", 45, "Near SLA")], "SLA Breached")
DISTANCE_BUCKET = (
    [("<=", 3, "Short (0-3 km)"), ("<=", 7, "Medium (3-7 km)"), ("<=", 12, "Long (7-12 km)")],
    "Very Long (12+ km)",
)
RFM_SEGMENT = (
    [(">=", 13, "Champions"), (">=", 10, "Loyal Customers"), (">=", 7, "Potential Loyalists"),
     (">=", 4, "At Risk")],
    "Churned",
)
SENTIMENT = ([(">=", 4, "Positive"), ("<=", 2, "Negative")], "Neutral")
DQ_STATUS = ([(">=", 95, "PASS"), (">=", 80, "WARN")], "FAIL")

# Order pricing rule: tax is 5 % of the discounted subtotal.
TAX_RATE = 0.05

# Day names by Spark's dayofweek (1 = Sunday).
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

DELIVERED_STATUSES = ["DELIVERED"]
CANCELLED_STATUSES = ["CANCELLED", "REFUNDED"]
CHURN_SEGMENTS = ["At Risk", "Churned"]

# Email rule applied to silver customers (multi-label domains do not match).
EMAIL_PATTERN = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z]{2,}$"
PHONE_STRIP_PATTERN = r"[^0-9+]"

# Performance tier: dense rank <= 50, then percent rank <= 0.1 / <= 0.25.
TOP_N_RANK = 50
TOP_PCT_1 = 0.1
TOP_PCT_2 = 0.25

# --- Fixed values: quality thresholds ---
THRESHOLDS = {
    "min_pass_rate_pct": 95.0,
    "max_null_pct": 5.0,
    "max_duplicate_pct": 1.0,
    "min_row_count": {"customers": 1000, "restaurants": 100, "orders": 10000, "deliveries": 5000, "reviews": 5000},
}
