"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

The chain is driver tables -> adapter entities -> silver -> gold -> report. A frame
that a query reads more than once is written once under the checkpoint folder;
the rest is lazy. Every query reads the whole driver tables. Outputs go through
:func:`quayside.plans.present.present` (text timestamps, bigint integers,
double numbers) so they can be compared with the SQL oracle.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.plans import dashboard as D
from quayside.plans import gold as G
from quayside.plans import silver as S
from quayside.plans.present import present, typed_output
from quayside.session import scratch_path
from quayside.sources import tpch

# Fixed report date of the registered queries (after the last order date), so
# recency is reproducible.
AS_OF = "2002-01-01"
SILVER_ORDER = ("customers", "restaurants", "orders", "deliveries", "reviews")


class Frames(Mapping):
    """Named frames, each built when it is first asked for."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders, self._built = builders, {}

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` (a written copy) takes the place of frame ``name``."""
        self._built[name] = df
        return df


class Chain:
    """The frames of one dataset directory, built on demand.

    Frames that later ones read more than once (deduplicated lines, silver tables, the
    bases of ranks and reports) are written once under the shared checkpoint folder
    and read back, so no query derives them again; everything else is lazy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.t = tpch.Tables(spark, sf_dir)
        self._root = scratch_path(spark, "queries", "chain", uuid.uuid4().hex)
        self._stored: dict[str, DataFrame] = {}
        b = self.bronze = Frames({
            "customers": lambda: tpch.customers(self.t),
            "restaurants": lambda: tpch.restaurants(self.t),
            "orders": lambda: tpch.orders(self.t, self.stored("lines", self.lines)),
            "deliveries": lambda: tpch.deliveries(self.t, self.stored("lines", self.lines)),
            "reviews": lambda: tpch.reviews(self.t),
        })
        kept = Frames({name: lambda name=name: self._kept(name) for name in SILVER_ORDER})
        self.kept = kept
        self.silver = Frames({
            "customers": lambda: S.silver_customers(b["customers"]),
            "restaurants": lambda: S.silver_restaurants(b["restaurants"]),
            "orders": lambda: S.silver_orders(b["orders"], kept["customers"], kept["restaurants"]),
            "deliveries": lambda: S.silver_deliveries(b["deliveries"], kept["orders"]),
            "reviews": lambda: S.silver_reviews(b["reviews"]),
        })
        self.gold = G.GoldFrames(kept, as_of=as_of, store=self.stored)

    @property
    def lines(self) -> DataFrame:
        return tpch.lines(self.t)

    def _kept(self, name: str) -> DataFrame:
        """A stored silver table; what orders are made of is written at the same time."""
        if name == "orders":
            self.together(lambda: self.stored("lines", self.lines), lambda: self.kept["customers"], lambda: self.kept["restaurants"])
        return self.stored(f"silver_{name}", self.silver[name])

    def together(self, *makes: Callable[[], DataFrame]) -> list[DataFrame]:
        """Frames that don't need each other, written at the same time."""
        with ThreadPoolExecutor(len(makes)) as pool:
            return list(pool.map(lambda make: make(), makes))

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written once under ``name`` and read back."""
        if name not in self._stored:
            path = f"{self._root}/{name}"
            df.write.parquet(path)
            self._stored[name] = self.spark.read.schema(df.schema).parquet(path)
        return self._stored[name]


def _q(build: Callable[[Chain], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(Chain(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _silver_rejects(c: Chain, name: str) -> DataFrame:
    b, s = c.bronze, c.kept
    if name == "orders":
        return S.silver_orders(b["orders"], s["customers"], s["restaurants"], with_rejects=True)
    if name == "deliveries":
        return S.silver_deliveries(b["deliveries"], s["orders"], with_rejects=True)
    return getattr(S, f"silver_{name}")(b[name], with_rejects=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # flagship: scan -> dedup lines -> order totals -> silver -> fact -> monthly -> lag growth
    "revenue_summary": _q(lambda c: c.gold["agg_revenue_summary"]),
    # adapters / dedup
    "dedup_latest": _q(lambda c: c.lines),
    # silver
    "silver_customers": _q(lambda c: c.silver["customers"]),
    "silver_restaurants": _q(lambda c: c.silver["restaurants"]),
    "silver_orders": _q(lambda c: c.silver["orders"]),
    "silver_deliveries": _q(lambda c: c.silver["deliveries"]),
    "silver_reviews": _q(lambda c: c.silver["reviews"]),
    "ri_quarantine": _q(lambda c: _silver_rejects(c, "orders").where(F.col("_reject_reason").isNotNull())
                        .select("order_id", "customer_id", "restaurant_id", "_reject_reason")),
    # gold
    "customer_order_metrics": _q(lambda c: G.customer_order_metrics(c.kept["orders"])),
    "dim_customers": _q(lambda c: c.gold["dim_customers"]),
    "rfm_scores": _q(lambda c: c.gold["dim_customers"].select(
        "customer_id", "days_since_last_order", "total_orders", "lifetime_revenue", "recency_score",
        "frequency_score", "monetary_score", "rfm_score", "rfm_segment")),
    "dim_restaurants": _q(lambda c: c.gold["dim_restaurants"]),
    "fact_orders": _q(lambda c: c.gold["fact_orders"]),
    "daily_city_metrics": _q(lambda c: c.gold["agg_daily_city_metrics"]),
    "restaurant_performance": _q(lambda c: c.gold["agg_restaurant_performance"]),
    "customer_cohorts": _q(lambda c: c.gold["agg_customer_cohorts"]),
    "delivery_sla_report": _q(lambda c: c.gold["agg_delivery_sla_report"]),
    # dashboard
    "headline_kpis": _q(lambda c: D.headline_kpis(c.gold["fact_orders"], c.kept["customers"], c.kept["restaurants"])),
    "revenue_trend": _q(lambda c: D.revenue_trend(c.gold["agg_revenue_summary"])),
    "payment_breakdown": _q(lambda c: D.payment_breakdown(c.gold["fact_orders"])),
    "platform_breakdown": _q(lambda c: D.platform_breakdown(c.gold["fact_orders"])),
    "city_performance": _q(lambda c: D.city_performance(c.gold["agg_daily_city_metrics"])),
    "city_trend": _q(lambda c: D.city_trend(c.gold["agg_daily_city_metrics"])),
    "top_restaurants": _q(lambda c: D.top_restaurants(c.gold["agg_restaurant_performance"])),
    "type_distribution": _q(lambda c: D.type_distribution(c.gold["dim_restaurants"])),
    "rfm_distribution": _q(lambda c: D.rfm_distribution(c.gold["dim_customers"])),
    "segment_by_tier": _q(lambda c: D.segment_by_tier(c.gold["dim_customers"])),
    "cohort_listing": _q(lambda c: D.cohort_listing(c.gold["agg_customer_cohorts"])),
    "sla_overview": _q(lambda c: D.sla_overview(c.gold["agg_delivery_sla_report"])),
    "sla_by_city": _q(lambda c: D.sla_by_city(c.gold["agg_delivery_sla_report"])),
    "sla_by_vehicle": _q(lambda c: D.sla_by_vehicle(c.gold["agg_delivery_sla_report"])),
    "cuisine_revenue": _q(lambda c: D.cuisine_revenue(c.gold["fact_orders"])),
    "time_slot_analysis": _q(lambda c: D.time_slot_analysis(c.gold["fact_orders"])),
    "high_cancel_restaurants": _q(lambda c: D.high_cancel_restaurants(c.gold["dim_restaurants"])),
    "churn_risk": _q(lambda c: D.churn_risk(c.gold["dim_customers"])),
    "churn_count": _q(lambda c: D.churn_count(c.gold["dim_customers"])),
}


def _typed(name: str, fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return typed_output(name, fn(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _all_queries():
    from quayside.registry_ops import OP_QUERIES
    out = dict(QUERIES)
    out.update(OP_QUERIES)
    return {name: _typed(name, fn) for name, fn in out.items()}


ALL_QUERIES = _all_queries()
