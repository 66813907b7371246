"""Bitmap distinct counts and quantile sketches against plain aggregates."""

import random

from pyspark.sql import functions as F

from helpers import SF001
from quayside.operators import distinct as DI
from quayside.operators import quantiles as QU
from quayside.operators.ranks import SortKey
from quayside.registry import Chain

LEVELS = [["y", "m", "d"], ["y", "m"], []]


def facts(spark, n=6000):
    rnd = random.Random(4)
    rows = [(rnd.choice([1, 2]), rnd.choice([1, 2, None]), rnd.randrange(4), rnd.choice([None, *range(0, 900_000, 7)][:2000]),
             rnd.choice(["a", "b", "c", None])) for _ in range(n)]
    rows += [(3, 1, 0, None, None)]
    return spark.createDataFrame(rows, "y int, m int, d int, cust bigint, shop string")


def test_bitmap_counts_equal_count_distinct(spark):
    df = facts(spark)
    ids = {c: DI.dense_ids(df, c) for c in ("cust", "shop")}
    assert ids["cust"].agg(F.min("n"), F.max("n") - F.count("n")).first() == (1, 0)
    got = DI.distinct_rollup(df, LEVELS, {"custs": "cust", "shops": "shop"}, ids)
    for keys, counts in zip(LEVELS, got, strict=True):
        want = df.groupBy(*keys).agg(F.count_distinct("cust").alias("custs"), F.count_distinct("shop").alias("shops"))
        assert sorted(map(str, counts.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_bitmap_counts_over_many_blocks(spark):
    df = spark.range(200_000).select((F.col("id") % 3).alias("y"), (F.col("id") * 11 % 150_001).alias("cust"))
    got = DI.distinct_rollup(df, [["y"], []], {"custs": "cust"}, {"cust": DI.dense_ids(df, "cust")})
    assert got[1].first().custs == df.select("cust").distinct().count()


def test_dense_ids_by_another_order(spark):
    df = spark.createDataFrame([("a", 5), ("b", 1), ("a", 3), (None, 0), ("c", 9)], "v string, day int")
    assert {r.v: r.n for r in DI.dense_ids(df, "v", SortKey.asc("day")).collect()} == {"b": 1, "a": 2, "c": 3}


def test_one_scan_of_the_fact_serves_all_columns(spark):
    fact = Chain(spark, SF001).gold["fact_orders"].select("order_date", "customer_id", "restaurant_id")
    ids = {c: spark.range(1, 50).select(F.col("id").alias(c), F.col("id").alias("n")) for c in ("customer_id", "restaurant_id")}
    maps = DI.id_bitmaps(fact, ["order_date"], {"c": "customer_id", "r": "restaurant_id"}, ids)
    plan = maps._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("FileScan parquet")[1:] if "order_date" in x.split("ReadSchema")[1][:400]]
    assert len(scans) == 1 and "Expand" not in plan


def test_sketches_merge_and_stay_in_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 30).alias("d"), (F.col("id") % 3).alias("m"), (F.pow(F.col("id") * 7919 % 60_000, 2)).alias("v"))
    df = df.unionByName(spark.createDataFrame([(0, 0, None), (99, 9, None)], "d bigint, m bigint, v double"))
    days = QU.sketches(df, ["m", "d"], "v")
    for keys in (["m"], []):
        answers = QU.merge_sketches(days, keys).select(*keys, QU.quantile().alias("median"))
        checked = QU.rank_check(df, answers, keys, "v", "median").collect()
        assert len(checked) == (3 if keys else 1) and all(r.within_bound for r in checked) and sum(r.n for r in checked) == 60_000
    wrong = spark.createDataFrame([(5.0,)], "median double")
    assert not QU.rank_check(df, wrong, [], "v", "median").first().within_bound


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 4.0, 9.0, 100.0)], "v double")
    assert QU.sketches(df, [], "v").select(QU.quantile().alias("q")).first().q == 4.0
