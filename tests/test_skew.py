"""A key holding a third of all rows: results stay whole and AQE splits the hot partition."""

from pyspark.sql import functions as F

from quayside.operators.dedup import dedup_latest
from quayside.operators.integrity import ri_filter


def _skewed(spark, n=30000):
    # customer 0 has a third of the orders
    return spark.range(n).select(F.col("id").alias("order_id"),
                                 F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
                                 .alias("customer_id"),
                                 (F.col("id") % 100).cast("double").alias("amount"))


def test_hot_key_join_is_split_and_whole(spark):
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        orders = _skewed(spark)
        customers = spark.range(998).select(F.col("id").alias("customer_id"),
                                            F.concat(F.lit("c"), F.col("id")).alias("name"))
        joined = orders.join(customers, "customer_id", "left")
        rows = joined.agg(F.count(F.lit(1)), F.count("name"), F.sum("amount")).first()
        assert tuple(rows) == (30000, 30000, float(sum(i % 100 for i in range(30000))))
        assert len(joined.collect()) == 30000            # runs this very plan, finalising AQE
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan                      # the hot partition was split at run time
        kept = ri_filter(orders, [(customers, "customer_id")])
        assert kept.count() == 30000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_key_dedup_keeps_one_row(spark):
    copies = _skewed(spark).select(F.lit(1).alias("k"), "order_id", "amount")   # one key, 30,000 copies
    out = dedup_latest(copies, ["k"], ["order_id"]).collect()
    assert len(out) == 1 and out[0]["order_id"] == 29999
