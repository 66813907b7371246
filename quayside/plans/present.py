"""Output normalisation for reports and cross-engine checks.

Timestamps, dates and arrays become text (``yyyy-MM-dd HH:mm:ss[.ffffff]``,
``[a, b]``), integers become bigint, floats and decimals become double. The
same rules are applied on the SQL oracle side, so two engines can be compared
value by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TECH_TIME_COLUMNS = ("_silver_loaded_at", "_gold_loaded_at", "_bronze_loaded_at")


def present(df: DataFrame, drop_load_times: bool = True) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if drop_load_times and f.name in TECH_TIME_COLUMNS:
            continue
        c, dt = F.col(f"`{f.name}`"), f.dataType
        if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType, T.ArrayType)):
            c = c.cast("string")
        elif isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(dt, (T.FloatType, T.DecimalType)):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# Output columns that can hold NULL integers or booleans. Through pandas, Spark
# turns a nullable integer into float64 (and a nullable boolean into object)
# while other engines keep nullable integer / boolean types; both sides of a
# cross-engine check therefore emit these as double (integers) or text
# (booleans). The frames returned by the library keep their own types.
_DIM_CUST_INTS = ["delivered_orders", "cancelled_orders", "unique_restaurants", "distinct_order_days",
                  "total_reviews", "days_since_last_order", "signup_year", "signup_month"]
_DIM_REST_INTS = ["total_orders_received", "total_delivered", "total_cancelled", "unique_customers",
                  "active_days", "review_count", "positive_reviews", "negative_reviews", "sla_met_count",
                  "total_delivery_count", "num_cuisines", "total_reviews"]
NULLABLE_OUTPUT: dict[str, dict[str, list[str]]] = {
    "silver_customers": {"double": ["signup_year", "signup_month"]},
    "silver_restaurants": {"double": ["num_cuisines", "total_reviews"]},
    "silver_deliveries": {"double": ["delivery_rating"]},
    "silver_reviews": {"double": ["order_id", "upvotes"], "text": ["has_photo"]},
    "ri_quarantine": {"double": ["customer_id", "restaurant_id"]},
    "silver_orders": {"double": ["num_items"]},
    "dim_customers": {"double": _DIM_CUST_INTS},
    "rfm_scores": {"double": ["days_since_last_order"]},
    "churn_risk": {"double": ["days_since_last_order"]},
    "dim_restaurants": {"double": _DIM_REST_INTS},
    "health_score": {"double": ["positive_reviews", "negative_reviews"]},
    "restaurant_performance": {"double": ["total_orders_received", "unique_customers"]},
    "fact_orders": {"double": ["num_items", "delivery_time_mins", "delivery_rating"]},
    "scan_contract": {"double": ["num_items"]},
    "full_load": {"double": ["num_items"]},
    "filter_between": {"double": ["raw_rating", "rating"]},
    "nullify_invalid": {"double": ["raw_rating", "delivery_rating"]},
    "sentiment_label": {"double": ["rating"]},
    "safe_pct": {"double": []},
    "merge_replay": {"double": ["marker"]},
    "fact_bucketed": {"double": ["num_items", "delivery_time_mins", "delivery_rating"]},
    "stream_bronze": {"double": ["num_items"]},
    "alter_table": {"double": ["loyalty_points"]},
}


def typed_output(name: str, df: DataFrame) -> DataFrame:
    spec = NULLABLE_OUTPUT.get(name, {})
    cols = {c: F.col(c).cast("double") for c in spec.get("double", []) if c in df.columns}
    cols.update({c: F.col(c).cast("string") for c in spec.get("text", []) if c in df.columns})
    return df.withColumns(cols) if cols else df
