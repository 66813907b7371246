"""The setup guide's two sample tables, re-aimed onto the driver tables.

* ``customers_managed`` (customer_id, first_name, last_name, email, phone,
  created_date, country, is_active) from customer + nation;
* ``sales_orders`` (order_id, customer_id, order_date, product_code, quantity,
  unit_price, total_amount, status) with one row per deduplicated line item:
  status COMPLETED for shipped-and-closed lines (``l_linestatus = 'F'``),
  PENDING otherwise; money as decimal(10,2) as in the guide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.sources import tpch


def customers_managed(t: tpch.Tables) -> DataFrame:
    first_order = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.min("o_orderdate").alias("first_order_date"))
    c = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(first_order, "c_custkey", "left"))
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(""))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("555-"), F.lpad(F.col("c_custkey").cast("string"), 4, "0")).alias("phone"),
        F.to_date("first_order_date").alias("created_date"),
        F.col("n_name").alias("country"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )


def sales_orders(t: tpch.Tables, lines_df: DataFrame | None = None) -> DataFrame:
    lines_df = tpch.lines(t) if lines_df is None else lines_df
    o = lines_df.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    price = F.col("l_extendedprice").cast("decimal(10,2)")
    return o.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("l_shipdate").alias("order_date"),
        F.concat(F.lit("PROD-"), F.col("l_partkey").cast("string")).alias("product_code"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (price / F.col("l_quantity").cast("int")).cast("decimal(10,2)").alias("unit_price"),
        price.alias("total_amount"),
        F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("PENDING").alias("status"),
    )


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Guide CTAS (join form): active customers x their orders."""
    c, o = customers.alias("c"), orders.alias("o")
    return (c.join(o, F.col("c.customer_id") == F.col("o.customer_id"), "inner")
            .where(F.col("c.is_active"))
            .select(F.col("c.customer_id"),
                    F.concat(F.col("c.first_name"), F.lit(" "), F.col("c.last_name")).alias("customer_name"),
                    F.col("c.country"), F.col("o.order_id"), F.col("o.order_date"), F.col("o.product_code"),
                    F.col("o.quantity"), F.col("o.total_amount"), F.col("o.status")))


def customer_revenue_summary(customer_orders_df: DataFrame) -> DataFrame:
    """Guide CTAS (aggregate form): completed revenue per customer."""
    return (customer_orders_df.where(F.col("status") == "COMPLETED")
            .groupBy("customer_id", "customer_name", "country")
            .agg(F.count("order_id").alias("total_orders"),
                 F.sum("total_amount").alias("total_revenue"),
                 F.avg("total_amount").alias("avg_order_value"),
                 F.max("order_date").alias("last_order_date")))
