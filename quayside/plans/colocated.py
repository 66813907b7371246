"""Joins without an exchange: orders and deliveries stored in the same buckets.

Both tables are bucketed and sorted on ``order_id`` when they are written, so every
later join on it reads bucket against bucket; only the small dimensions move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.plans import gold as G


def store_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` by ``keys``, one sorted file each; read by name."""
    w = (df.repartition(buckets, *[F.col(k) for k in keys]).write.mode("overwrite")
         .bucketBy(buckets, *keys).sortBy(*keys))
    (w.option("path", path) if path else w).saveAsTable(table)
    return df.sparkSession.table(table)


def colocated_fact(orders: DataFrame, customers: DataFrame, restaurants: DataFrame, deliveries: DataFrame, *,
                   as_of=None) -> DataFrame:
    """The order fact from bucketed ``orders`` and bucketed first ``deliveries``."""
    return G.fact_orders(orders, customers, restaurants, deliveries, as_of=as_of)
