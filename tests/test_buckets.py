import pytest
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.functions.columns import bucket
from quayside.operators.ranks import SortKey, global_ranks

CASES = {
    "segment": (K.CUSTOMER_SEGMENT, [(100, "Power User"), (99, "Regular"), (30, "Regular"), (29, "Occasional"),
                                     (5, "Occasional"), (4, "New"), (None, "New")]),
    "slot": (K.ORDER_TIME_SLOT, [(5, "Late Night"), (6, "Breakfast"), (10, "Breakfast"), (11, "Lunch"),
                                 (14, "Lunch"), (15, "Snacks"), (17, "Snacks"), (18, "Dinner"), (22, "Dinner"),
                                 (23, "Late Night"), (None, "Late Night")]),
    "sla": (K.DELIVERY_SLA_STATUS, [(30, "Within SLA"), (31, "Near SLA"), (45, "Near SLA"), (46, "SLA Breached"),
                                    (None, "SLA Breached")]),
    "distance": (K.DISTANCE_BUCKET, [(3.0, "Short (0-3 km)"), (3.01, "Medium (3-7 km)"), (7.0, "Medium (3-7 km)"),
                                     (12.0, "Long (7-12 km)"), (12.01, "Very Long (12+ km)"),
                                     (None, "Very Long (12+ km)")]),
    "rfm": (K.RFM_SEGMENT, [(15, "Champions"), (13, "Champions"), (12, "Loyal Customers"), (10, "Loyal Customers"),
                            (9, "Potential Loyalists"), (7, "Potential Loyalists"), (6, "At Risk"), (4, "At Risk"),
                            (3, "Churned"), (None, "Churned")]),
    "sentiment": (K.SENTIMENT, [(5, "Positive"), (4, "Positive"), (3, "Neutral"), (2, "Negative"), (1, "Negative"),
                                (None, "Neutral")]),
    "status": (K.DQ_STATUS, [(95.0, "PASS"), (94.99, "WARN"), (80.0, "WARN"), (79.99, "FAIL"), (None, "FAIL")]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_bucket_bounds(spark, name):
    rules, cases = CASES[name]
    dtype = "double" if any(isinstance(v, float) for v, _ in cases) else "int"
    df = spark.createDataFrame([(v,) for v, _ in cases], f"v {dtype}")
    got = [r[0] for r in df.select(bucket("v", *rules)).collect()]
    assert got == [label for _, label in cases]


def test_all_tied_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(23).select(F.col("id").cast("string").alias("id"), F.lit(7).alias("k"))
    for buckets in (1, 6):
        out = global_ranks(df, [SortKey.desc("k")], ["id"], {"nt": ("ntile", 5)}, buckets=buckets)
        sizes = sorted(r["count"] for r in out.groupBy("nt").count().collect())
        assert sizes == [4, 4, 5, 5, 5]
