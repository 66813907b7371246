"""quayside: a Spark-native medallion analytics engine for an order-and-delivery marketplace.

Layers: ``sources`` (landing scans, adapters, sinks), ``plans`` (silver, gold,
dashboard, table DML), ``operators`` (dedup, integrity, quality, ranks, upsert),
``functions`` (column helpers), ``streaming`` (incremental bronze).
"""

__version__ = "0.1.0"
