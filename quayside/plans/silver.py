"""Silver layer: deduplicate, clean and conform the five entities.

Each ``silver_*`` function takes the bronze (or landing-shaped) frame and
returns the valid rows. With ``with_rejects=True`` it returns every
deduplicated row once, plus ``_reject_reason`` (NULL when valid) and
``_nulls_filled``; the runner writes that once as the silver table and its
quarantine.

No action runs inside; timestamps are parsed to ``timestamp_ntz`` with
``try_cast`` (bad text gives NULL, independent of the session time zone).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.functions.columns import bucket, clamp_negative, flag, nullify_outside, standardize
from quayside.operators.dedup import dedup_latest
from quayside.operators.integrity import ri_filter, ri_split

# Newest load first where the frame carries a load time (bronze tables do; frames
# straight from an adapter don't).
LOAD_ORDER = ["_bronze_loaded_at"]
DROPPED = set(K.SILVER_DROP)
Store = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


# A time of day followed by Z or an offset such as +05:30, +0530 or -08.
OFFSET_TIME = r"\d{1,2}:\d{2}.*(?:Z|[+-]\d{1,2}(?::?\d{2})?)\s*$"


def parse_ts(c: str | Column, zone: str = "UTC") -> Column:
    """Text to wall-clock time (``timestamp_ntz``); bad text gives NULL.

    Text with a UTC offset names an instant and becomes the wall clock of ``zone``;
    text without one is taken as it stands. Neither depends on the session zone.
    """
    c = F.col(c) if isinstance(c, str) else c
    instant = F.unix_micros(c.try_cast("timestamp")).cast("decimal(18,0)") / F.lit(1_000_000).cast("decimal(7,0)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), instant.cast("decimal(18,6)"))
    there = utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)
    # the pattern is tried only where a sign or Z comes after the first colon (it needs one)
    text = c.cast("string")
    tail = F.substr(text, F.instr(text, ":"))
    possible = tail.contains("Z") | tail.contains("+") | tail.contains("-")
    return F.when(possible & F.rlike(text, F.lit(OFFSET_TIME)), there).otherwise(c.try_cast("timestamp_ntz"))


def _newest(df: DataFrame, entity: str) -> DataFrame:
    """One row per key, the newest load first. The technical columns at the end of a bronze
    table leave silver; as last tie-breaks they would only choose between rows that are equal
    in all other columns, so they go before the rows move."""
    names = list(df.columns)
    while names and names[-1] in DROPPED:
        names.pop()
    order = [c for c in LOAD_ORDER if c in df.columns]
    held = df.select(*[F.col(f"`{c}`") for c in names], *[c for c in order if c not in names])
    return dedup_latest(held, K.PRIMARY_KEYS[entity], LOAD_ORDER, optional=LOAD_ORDER)


def _loaded(loaded_at: Column | None) -> Column:
    return F.current_timestamp() if loaded_at is None else loaded_at


def _fill(defaults: dict[str, object]) -> tuple[dict[str, Column], Column]:
    """``coalesce`` each column with its default and count how many were filled."""
    cols = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()}
    filled = sum((F.col(c).isNull().cast("int") for c in defaults), F.lit(0))
    return cols, filled


def _finish(df: DataFrame, reason: Column, with_rejects: bool) -> DataFrame:
    if with_rejects:
        return df.withColumn("_reject_reason", reason)
    return df.where(reason.isNull()).drop("_nulls_filled")


def _score(n_defaults: int) -> Column:
    return F.round(F.lit(1.0) - F.col("_nulls_filled") / F.lit(float(n_defaults)), 2)


def silver_customers(df: DataFrame, *, loaded_at: Column | None = None,
                     with_rejects: bool = False) -> DataFrame:
    df = _newest(df, "customers")
    defaults = {"subscription_tier": "Free", "is_active": True, "total_orders_lifetime": 0,
                "avg_order_value": 0.0}
    filled_cols, filled = _fill(defaults)
    df = (df
          .withColumns({"first_name": standardize("first_name"), "last_name": standardize("last_name"),
                        "email": F.lower(F.trim("email")),
                        "phone_cleaned": F.regexp_replace("phone", K.PHONE_STRIP_PATTERN, ""),
                        "signup_date": parse_ts("signup_date"),
                        "city": standardize("city"),
                        "_nulls_filled": filled})
          .withColumns({"full_name": F.concat_ws(" ", "first_name", "last_name"),
                        "signup_year": F.year("signup_date"), "signup_month": F.month("signup_date"),
                        **filled_cols})
          .withColumns({"customer_segment": bucket("total_orders_lifetime", *K.CUSTOMER_SEGMENT),
                        "_silver_loaded_at": _loaded(loaded_at),
                        "_data_quality_score": _score(len(defaults))})
          .drop(*K.SILVER_DROP))
    reason = (F.when(F.col("customer_id").isNull(), "null_customer_id")
              .when(F.col("email").isNull(), "null_email")
              .when(~F.col("email").rlike(K.EMAIL_PATTERN), "invalid_email"))
    return _finish(df, reason, with_rejects)


def silver_restaurants(df: DataFrame, *, loaded_at: Column | None = None,
                       with_rejects: bool = False) -> DataFrame:
    df = _newest(df, "restaurants")
    defaults = {"is_delivering_now": False, "has_online_delivery": False,
                "has_table_booking": False, "is_premium_partner": False}
    filled_cols, filled = _fill(defaults)
    df = (df
          .withColumns({"name": standardize("name"), "city": standardize("city"),
                        "locality": standardize("locality"),
                        "cuisines_list": F.concat_ws(", ", "cuisines"),
                        "num_cuisines": F.size("cuisines"),
                        "onboarded_date": parse_ts("onboarded_date"),
                        "price_tier": bucket("avg_cost_for_two", *K.PRICE_TIER),
                        # tier from the unrounded rating, then the rating is rounded
                        "rating_tier": bucket("rating", *K.RATING_TIER),
                        "_nulls_filled": filled})
          .withColumns({"rating": F.round("rating", 1), **filled_cols,
                        "_silver_loaded_at": _loaded(loaded_at)})
          .drop(*K.SILVER_DROP))
    reason = (F.when(F.col("restaurant_id").isNull(), "null_restaurant_id")
              .when(F.col("name").isNull(), "null_name"))
    return _finish(df, reason, with_rejects)


def conform_orders(df: DataFrame, loaded_at: Column | None = None, store: Store = _as_is) -> DataFrame:
    """Dedup + derived columns of orders, before the referential checks."""
    df = store(_newest(df, "orders"))
    return (df
            .withColumns({"order_placed_at": parse_ts("order_placed_at"),
                          "order_status": F.upper(F.trim("order_status")),
                          "payment_status": F.upper(F.trim("payment_status")),
                          "total_amount": clamp_negative("total_amount")})
            .withColumns({"order_date": F.to_date("order_placed_at"),
                          "order_year": F.year("order_placed_at"),
                          "order_month": F.month("order_placed_at"),
                          "order_day_of_week": F.dayofweek("order_placed_at"),
                          "order_hour": F.hour("order_placed_at"),
                          # day name from dayofweek: no session time-zone conversion
                          "order_day_name": F.element_at(F.array(*[F.lit(d) for d in K.DAY_NAMES]),
                                                         F.dayofweek("order_placed_at")),
                          "is_delivered": flag(F.col("order_status").isin(*K.DELIVERED_STATUSES)),
                          "is_cancelled": flag(F.col("order_status").isin(*K.CANCELLED_STATUSES)),
                          "has_discount": flag(F.col("discount_pct") > 0),
                          "subtotal": F.round("subtotal", 2),
                          "total_amount": F.round("total_amount", 2),
                          "discount_amount": F.round("discount_amount", 2),
                          "tax_amount": F.round("tax_amount", 2),
                          "delivery_fee": F.round("delivery_fee", 2),
                          "_silver_loaded_at": _loaded(loaded_at)})
            .withColumn("order_time_slot", bucket("order_hour", *K.ORDER_TIME_SLOT))
            .drop(*K.SILVER_DROP))


def silver_orders(df: DataFrame, customers: DataFrame, restaurants: DataFrame, *,
                  loaded_at: Column | None = None, with_rejects: bool = False, store: Store = _as_is) -> DataFrame:
    """Orders whose customer and restaurant exist in the given silver frames. ``store`` may
    write the newest rows and read them back, so that their shuffle files go before the joins."""
    df = conform_orders(df, loaded_at, store)
    parents = [(customers, "customer_id"), (restaurants, "restaurant_id")]
    if with_rejects:
        return ri_split(df, parents).withColumn("_nulls_filled", F.lit(0))
    return ri_filter(df, parents)


def conform_deliveries(df: DataFrame, loaded_at: Column | None = None, store: Store = _as_is) -> DataFrame:
    df = store(_newest(df, "deliveries"))
    return (df
            .withColumns({"pickup_timestamp": parse_ts("pickup_timestamp"),
                          "delivered_timestamp": parse_ts("delivered_timestamp"),
                          "delivery_status": F.upper(F.trim("delivery_status")),
                          "vehicle_type": standardize("vehicle_type"),
                          "delivery_sla_status": bucket("delivery_time_mins", *K.DELIVERY_SLA_STATUS),
                          # bucket from the unrounded distance, then round
                          "distance_bucket": bucket("delivery_distance_km", *K.DISTANCE_BUCKET),
                          "delivery_rating": nullify_outside("delivery_rating", 1, 5)})
            .withColumns({"delivery_distance_km": F.round("delivery_distance_km", 2),
                          "_silver_loaded_at": _loaded(loaded_at)})
            .drop(*K.SILVER_DROP))


def silver_deliveries(df: DataFrame, orders: DataFrame, *, loaded_at: Column | None = None,
                      with_rejects: bool = False, store: Store = _as_is) -> DataFrame:
    df = conform_deliveries(df, loaded_at, store)
    parents = [(orders, "order_id")]
    if with_rejects:
        return ri_split(df, parents).withColumn("_nulls_filled", F.lit(0))
    return ri_filter(df, parents)


def silver_reviews(df: DataFrame, *, loaded_at: Column | None = None,
                   with_rejects: bool = False) -> DataFrame:
    df = _newest(df, "reviews")
    df = (df
          .withColumns({"review_timestamp": parse_ts("review_timestamp"),
                        "rating": nullify_outside("rating", 1, 5),
                        "review_text": F.trim("review_text"),
                        "sentiment_label": standardize("sentiment_label")})
          .withColumns({"review_date": F.to_date("review_timestamp"),
                        "review_text_length": F.coalesce(F.length("review_text"), F.lit(0)),
                        "_silver_loaded_at": _loaded(loaded_at),
                        "_nulls_filled": F.lit(0)})
          .drop(*K.SILVER_DROP))
    reason = (F.when(F.col("review_id").isNull(), "null_review_id")
              .when(F.col("rating").isNull(), "invalid_rating"))
    return _finish(df, reason, with_rejects)


def silver_all(bronze: dict[str, DataFrame], *, loaded_at: Column | None = None) -> dict[str, DataFrame]:
    """The five silver frames wired in dependency order (lazy, no action)."""
    cust = silver_customers(bronze["customers"], loaded_at=loaded_at)
    rest = silver_restaurants(bronze["restaurants"], loaded_at=loaded_at)
    orders = silver_orders(bronze["orders"], cust, rest, loaded_at=loaded_at)
    deliv = silver_deliveries(bronze["deliveries"], orders, loaded_at=loaded_at)
    rev = silver_reviews(bronze["reviews"], loaded_at=loaded_at)
    return {"customers": cust, "restaurants": rest, "orders": orders, "deliveries": deliv, "reviews": rev}
