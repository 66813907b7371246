"""Adapter views: the driver's TPC-H-like tables as the five marketplace entities.

Each function returns a frame in the landing-contract shape of its entity
(timestamps as ISO text, money as double), so the silver transforms run on it
exactly as on landed files. Keys stay numeric (bigint) for cheap joins.

Mapping (fixed choices of this adapter):

* lines       lineitem, newest copy per (l_orderkey, l_linenumber)
* customers   customer + nation + region; first order date as signup date
* restaurants supplier + nation + region; cuisines = part types sold at or
              above the supplier's average quantity per type
* orders      orders + line totals (decimal sums) + customer segment
* deliveries  one per line: minutes = quantity, km = discount x 150
* reviews     events: rating = floor(value) mod 7 (0 and 6 are invalid)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.dedup import dedup_latest

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SOURCE_SYSTEM = "tpch"


def iso_text(c) -> "F.Column":
    """ISO-8601 text of a ``timestamp_ntz`` that does not pass through the session
    time zone (formatting functions do, and shift wall-clock times in a DST gap)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(c.cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Tables:
    """Lazy accessor: ``Tables(spark, dir).lineitem`` reads one parquet file."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._cache = spark, sf_dir, {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]


def _tech(df: DataFrame) -> DataFrame:
    return df.withColumns({"_ingested_at": F.lit(None).cast("string"), "_source_system": F.lit(SOURCE_SYSTEM)})


def lines(t: Tables) -> DataFrame:
    """Line items, newest copy per (order, line number); ties broken by all other columns."""
    return dedup_latest(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def customers(t: Tables) -> DataFrame:
    first_order = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order_date"))
    c = (t.customer
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .join(first_order, "c_custkey", "left"))
    domain_end = F.when(F.col("c_acctbal") < 0, F.lit(".co.in")).otherwise(F.lit(".com"))
    return _tech(c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))), F.lit("@"),
                 F.lower(F.col("c_mktsegment")), domain_end).alias("email"),
        F.concat(F.lit("+"), (F.col("c_nationkey") + 10).cast("string"), F.lit("-"),
                 F.col("c_custkey").cast("string")).alias("phone"),
        F.concat(F.lit(" "), F.col("n_name")).alias("city"),
        F.col("r_name").alias("locality"),
        F.col("c_nationkey").cast("string").alias("pincode"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        iso_text("first_order_date").alias("signup_date"),
        F.col("r_name").alias("subscription_tier"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.lit(None).cast("string").alias("preferred_payment"),
        F.lit(None).cast("string").alias("preferred_cuisine"),
        F.floor(F.col("c_acctbal") / 50).cast("int").alias("total_orders_lifetime"),
        F.col("c_acctbal").alias("avg_order_value"),
    ))


def restaurants(t: Tables) -> DataFrame:
    # cuisines: the part types a supplier sells at or above its own average
    # quantity per type (over all line items); the window runs on the
    # per-(supplier, type) aggregate, at most one row per part type
    per_type = (t.lineitem.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
                .groupBy("l_suppkey", "p_type").agg(F.sum("l_quantity").alias("qty")))
    avg_qty = F.avg("qty").over(Window.partitionBy("l_suppkey"))
    cuisines = (per_type.withColumn("_avg", avg_qty).where(F.col("qty") >= F.col("_avg"))
                .groupBy(F.col("l_suppkey").alias("s_suppkey"))
                .agg(F.array_sort(F.collect_set("p_type")).alias("cuisines")))
    s = (t.supplier
         .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
         .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
         .join(cuisines, "s_suppkey", "left"))
    return _tech(s.select(
        F.col("s_suppkey").alias("restaurant_id"),
        F.lower(F.col("s_name")).alias("name"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("locality"),
        F.lit(None).cast("string").alias("address"),
        F.col("s_nationkey").cast("string").alias("pincode"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.col("cuisines"),
        F.col("r_name").alias("restaurant_type"),
        F.floor(F.col("s_acctbal") / 5).cast("int").alias("avg_cost_for_two"),
        ((F.col("s_suppkey") % 26 + 25).cast("double") / 10).alias("rating"),
        F.lit(None).cast("int").alias("total_reviews"),
        (F.col("s_acctbal") > 0).alias("is_delivering_now"),
        F.lit(None).cast("boolean").alias("has_online_delivery"),
        F.lit(None).cast("boolean").alias("has_table_booking"),
        F.lit(None).cast("boolean").alias("is_premium_partner"),
        F.lit(None).cast("string").alias("onboarded_date"),
        F.lit(None).cast("string").alias("owner_name"),
        F.lit(None).cast("string").alias("owner_phone"),
        F.lit(None).cast("string").alias("gst_number"),
    ))


def order_line_totals(lines_df: DataFrame) -> DataFrame:
    """Per-order totals from the lines, as exact decimal sums (partial aggregation)."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    return lines_df.groupBy("l_orderkey").agg(
        F.min("l_suppkey").alias("restaurant_id"),
        F.sum(price).alias("subtotal"),
        F.max("l_discount").alias("max_discount"),
        F.sum(price * disc).alias("discount_amount"),
        F.sum(price * (F.lit(1) - disc) * tax).alias("tax_amount"),
        F.count(F.lit(1)).alias("num_items"),
    )


def orders(t: Tables, lines_df: DataFrame | None = None) -> DataFrame:
    lines_df = lines(t) if lines_df is None else lines_df
    totals = order_line_totals(lines_df)
    seconds = F.pmod(F.round(F.col("o_totalprice") * 100).cast("bigint"), F.lit(86400))
    placed = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    o = (t.orders
         .join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left")
         .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"), "left"))
    status = (F.when(F.col("o_orderstatus") == "F", "Delivered")
              .when(F.col("o_orderstatus") == "O", "Placed")
              .when(F.col("o_orderstatus") == "P", "Cancelled"))
    pay_status = (F.when(F.col("o_orderstatus") == "F", "paid")
                  .when(F.col("o_orderstatus") == "P", "refunded")
                  .otherwise("pending"))
    return _tech(o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("restaurant_id"),
        iso_text(placed).alias("order_placed_at"),
        status.alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        pay_status.alias("payment_status"),
        F.col("c_mktsegment").alias("platform"),
        F.col("subtotal").cast("double").alias("subtotal"),
        (F.col("max_discount") * 100).alias("discount_pct"),
        F.col("discount_amount").cast("double").alias("discount_amount"),
        F.lit(None).cast("string").alias("coupon_code"),
        (F.col("num_items") * 5).cast("double").alias("delivery_fee"),
        F.col("tax_amount").cast("double").alias("tax_amount"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("num_items").cast("int").alias("num_items"),
        F.lit(None).cast("string").alias("special_instructions"),
    ))


def deliveries(t: Tables, lines_df: DataFrame | None = None) -> DataFrame:
    lines_df = lines(t) if lines_df is None else lines_df
    minutes = F.col("l_quantity").cast("int")
    delivered = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    return _tech(lines_df.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("delivery_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").cast("string").alias("delivery_partner_id"),
        F.lit(None).cast("string").alias("delivery_partner_name"),
        F.lit(None).cast("string").alias("partner_phone"),
        F.lower(F.col("l_returnflag")).alias("vehicle_type"),
        iso_text("l_shipdate").alias("pickup_timestamp"),
        iso_text(delivered).alias("delivered_timestamp"),
        minutes.alias("delivery_time_mins"),
        F.col("l_linestatus").alias("delivery_status"),
        (F.col("l_discount").cast("decimal(4,2)") * 150).cast("double").alias("delivery_distance_km"),
        (F.col("l_partkey") % 7 + 1).cast("int").alias("delivery_rating"),
    ))


def reviews(t: Tables) -> DataFrame:
    n_restaurants = t.supplier.select(F.count(F.lit(1))).scalar()
    raw_rating = F.pmod(F.floor(F.col("value")).cast("int"), F.lit(7))
    sentiment = (F.when(raw_rating >= 4, " positive")
                 .when(raw_rating <= 2, "negative ")
                 .otherwise("neutral"))
    return _tech(t.events.select(
        F.col("event_id").alias("review_id"),
        F.lit(None).cast("bigint").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.pmod(F.col("event_id"), n_restaurants).alias("restaurant_id"),
        raw_rating.alias("rating"),
        F.concat(F.lit(" "), F.col("event_type"), F.lit(" "), F.col("props"), F.lit(" ")).alias("review_text"),
        iso_text("ts").alias("review_timestamp"),
        sentiment.alias("sentiment_label"),
        (F.col("event_type") == "purchase").alias("is_verified_order"),
        F.lit(None).cast("int").alias("upvotes"),
        F.lit(None).cast("boolean").alias("has_photo"),
    ))
