"""Incremental silver and gold: an increment of orders recomputes its months only.

Tables that are read by month are catalog tables partitioned by (order_year,
order_month). An increment's *touched* months are those of its rows and those that the
rows it replaces were in (an order may move to another month); the old rows come from
the bronze buckets of its keys, not from a scan. The touched months travel on:

* bronze: bucketed upsert;
* silver orders: the touched months' rows without the increment's keys, and the
  increment's valid rows;
* order fact, daily city metrics and monthly revenue: rebuilt from the touched months of
  the layer below.

Every table swaps whole months (dynamic partition overwrite); files of other months
stay as they are, and a month that lost all its rows is dropped. Growth between
months is computed when the monthly table is read: one row a month.

A change of customers, restaurants or deliveries can touch any month; build the layers again
for those (:meth:`IncrementalGold.build`).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.plans import gold as G
from quayside.plans import silver as S
from quayside.plans.bucketed import BucketedTable, overwrite_mode

MONTH = ("order_year", "order_month")


def in_months(months: Sequence[tuple]) -> Column:
    """Rows of the given months (a NULL month is one of them)."""
    return reduce(or_, [F.col(MONTH[0]).eqNullSafe(F.lit(y)) & F.col(MONTH[1]).eqNullSafe(F.lit(m)) for y, m in months],
                  F.lit(False))


class MonthTable:
    """A managed catalog table partitioned by month; whole months are swapped."""

    def __init__(self, spark: SparkSession, name: str, fmt: str = "parquet"):
        self.spark, self.name, self.fmt = spark, name, fmt

    def read(self, months: Sequence[tuple] | None = None) -> DataFrame:
        table = self.spark.table(self.name)
        return table if months is None else table.where(in_months(months))

    def replace(self, df: DataFrame) -> DataFrame:
        with overwrite_mode(self.spark, "static"):
            (df.hint("rebalance", *[F.col(c) for c in MONTH]).write.format(self.fmt).mode("overwrite")
             .partitionBy(*MONTH).saveAsTable(self.name))
        return self.read()

    def swap(self, df: DataFrame, months: Sequence[tuple]) -> DataFrame:
        """``df`` becomes the rows of ``months``; it may read this table."""
        columns = self.read().columns
        with overwrite_mode(self.spark, "dynamic"):
            (df.select(*[f"`{c}`" for c in columns]).hint("rebalance", *[F.col(c) for c in MONTH])
             .write.mode("overwrite").insertInto(self.name))
        # months without a new row keep what they had: which ones the input says, a month each
        filled = {tuple(r) for r in df.select(*MONTH).distinct().collect()} if months else set()
        for y, m in set(months) - filled:
            at = ", ".join(f"{c} = {'null' if v is None else v}" for c, v in zip(MONTH, (y, m), strict=True))
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({at})")
        return self.read()


class IncrementalGold:
    """Bronze orders and the layers above them, kept up to date by increments.

    ``database`` holds the tables, ``root`` the bronze files. ``customers``,
    ``restaurants`` and ``deliveries`` are silver frames (one delivery per order).
    """

    def __init__(self, spark: SparkSession, database: str, root: str, customers: DataFrame, restaurants: DataFrame,
                 deliveries: DataFrame, as_of=None):
        self.spark, self.as_of = spark, as_of
        self.customers, self.restaurants, self.deliveries = customers, restaurants, deliveries
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.bronze = BucketedTable(spark, f"{root}/orders", K.PRIMARY_KEYS["orders"], f"{database}.bronze_orders")
        self.silver, self.fact, self.daily, self.monthly = (
            MonthTable(spark, f"{database}.{n}") for n in ("silver_orders", "fact_orders", "agg_daily_city_metrics", "monthly_revenue"))

    def _silver_of(self, orders: DataFrame) -> DataFrame:
        loaded = F.current_timestamp() if self.as_of is None else F.lit(self.as_of).cast("timestamp")
        return S.silver_orders(orders, self.customers, self.restaurants, loaded_at=loaded)

    def _fact_of(self, orders: DataFrame) -> DataFrame:
        return G.fact_orders(orders, self.customers, self.restaurants, self.deliveries, as_of=self.as_of)

    def build(self, orders: DataFrame, buckets: int) -> None:
        """All layers from landed ``orders``."""
        bronze = self.bronze.replace(orders, buckets)
        fact = self.fact.replace(self._fact_of(self.silver.replace(self._silver_of(bronze))))
        self.daily.replace(G.daily_city_metrics(fact, as_of=self.as_of))
        self.monthly.replace(G.monthly_revenue(fact))

    def touched_months(self, increment: DataFrame) -> list[tuple]:
        """Months of the increment's rows and of the rows that they replace: bounded by the calendar."""
        old = self.bronze.matching(increment)
        both = old.select("order_placed_at").unionByName(increment.select("order_placed_at"))
        when = S.parse_ts("order_placed_at")
        return [tuple(r) for r in both.select(F.year(when), F.month(when)).distinct().collect()]

    def apply(self, increment: DataFrame, order_cols: Sequence[str] = ()) -> list[tuple]:
        """Take in landed ``increment`` rows of orders; returns the months that were recomputed.
        Replaying an increment changes nothing."""
        months = self.touched_months(increment)
        if not months:
            return []
        self.bronze.merge(increment, order_cols)
        # the increment's keys as they are stored now: one row each
        rows = self._silver_of(self.bronze.matching(increment))
        keys = increment.select(*[F.col(k).alias(f"_k_{k}") for k in self.bronze.keys])
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in self.bronze.keys])
        rest = self.silver.read(months).join(keys, same, "left_anti")
        self.silver.swap(rest.unionByName(rows), months)
        self.fact.swap(self._fact_of(self.silver.read(months)), months)
        fact = self.fact.read(months)
        self.daily.swap(G.daily_city_metrics(fact, as_of=self.as_of), months)
        self.monthly.swap(G.monthly_revenue(fact), months)
        return months

    def revenue_summary(self) -> DataFrame:
        return G.revenue_growth(self.monthly.read(), as_of=self.as_of)
