"""Global ranks must equal Spark's single-partition window functions."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quayside.operators.ranks import SortKey, global_ranks, histogram_ranks, ntile_from_row_number

OUTPUTS = {"rn": ("row_number",), "rk": ("rank",), "dr": ("dense_rank",), "pr": ("percent_rank",),
           "nt5": ("ntile", 5), "nt3": ("ntile", 3)}


def _order(key):
    c = F.col(key.column)
    if key.ascending:
        return c.asc_nulls_last() if key.nulls_last else c.asc_nulls_first()
    return c.desc_nulls_last() if key.nulls_last else c.desc_nulls_first()


def window_ranks(df, key, outputs=OUTPUTS):
    full, peers = Window.orderBy(_order(key), "id"), Window.orderBy(_order(key))
    fns = {"row_number": lambda: F.row_number().over(full), "rank": lambda: F.rank().over(peers),
           "dense_rank": lambda: F.dense_rank().over(peers), "percent_rank": lambda: F.percent_rank().over(peers)}
    return df.withColumns({n: F.ntile(k[1]).over(full) if k[0] == "ntile" else fns[k[0]]() for n, k in outputs.items()})


def _collect(df):
    return sorted(tuple(r) for r in df.select("id", *OUTPUTS).collect())


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(700):
        n = rnd.randrange(40)
        rows.append((f"id{i:05d}", None if rnd.random() < 0.1 else n, rnd.choice([float("nan"), None, 0.0, -0.0, n / 3, -1e300]),
                     f"2024-{n % 12 + 1:02d}-01" if n else None, rnd.choice(["", "a", "Z", "é", None, "b" * n]),
                     rnd.choice([-2 ** 63, 2 ** 63 - 1, 0, None]), 7 if i % 2 else i))
    return spark.createDataFrame(rows, "id string, k int, d double, day string, s string, b bigint, hot int").withColumn(
        "day", F.to_date("day")).repartition(5).cache()


@pytest.mark.parametrize("column", ["k", "d", "day", "s", "b", "hot"])
def test_ranks_equal_windows(frame, column):
    for key in (SortKey.asc(column), SortKey.asc(column, nulls_last=True), SortKey.desc(column), SortKey.desc(column, nulls_last=False)):
        assert _collect(global_ranks(frame, [key], ["id"], OUTPUTS, buckets=13)) == _collect(window_ranks(frame, key))


def test_hot_tie_group_spans_buckets(spark, frame):
    out = global_ranks(frame, [SortKey.desc("hot")], ["id"], {"rn": ("row_number",)}, buckets=16)
    assert out.where("hot = 7").select("rn").distinct().count() == frame.where("hot = 7").count()


@pytest.mark.parametrize("rows_", [[], [("a", 1)], [("a", None), ("b", None), ("c", None)]])
@pytest.mark.parametrize("buckets", [1, 4, None])
def test_edge_cases(spark, rows_, buckets):
    df = spark.createDataFrame(rows_, "id string, k int")
    key = SortKey.asc("k", nulls_last=True)
    assert _collect(global_ranks(df, [key], ["id"], OUTPUTS, buckets=buckets)) == _collect(window_ranks(df, key))


def test_nothing_runs_before_the_action(spark):
    sc = spark.sparkContext
    sc.setJobGroup("lazy-ranks", "builder")
    df = spark.range(1000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("k"))
    global_ranks(df, [SortKey.desc("k")], ["id"], OUTPUTS)
    assert list(sc.statusTracker().getJobIdsForGroup("lazy-ranks")) == []
    sc.setJobGroup("", "")


def test_ntile_formula_matches_spark(spark):
    for n in range(1, 40):
        df = spark.range(n).withColumn("t", F.ntile(5).over(Window.orderBy("id")))
        got = df.select("id", ntile_from_row_number(F.col("id") + 1, F.lit(n), 5).alias("f"), "t").collect()
        assert all(r["f"] == r["t"] for r in got)


def _hist(df):
    return histogram_ranks(df, "score", "city", low=0, high=10, decimals=1, city_rank="cr", overall_rank="dr", overall_pct="pr")


def test_histogram_ranks_match_window(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["c0", "c1", "c2", None]), round(rnd.random() * 10, 1) if rnd.random() > 0.1 else None)
            for i in range(500)]
    df = spark.createDataFrame(rows, "id int, city string, score double")
    wc = Window.partitionBy("city").orderBy(F.col("score").desc())
    wa = Window.orderBy(F.col("score").desc())
    exp = df.select("id", F.dense_rank().over(wc).alias("cr"), F.dense_rank().over(wa).alias("dr"), F.percent_rank().over(wa).alias("pr"))
    assert sorted(map(tuple, _hist(df).select("id", "cr", "dr", "pr").collect())) == sorted(map(tuple, exp.collect()))


@pytest.mark.parametrize("score", [10.1, -0.1, 0.05])
def test_histogram_ranks_reject_values_outside_the_domain(spark, score):
    with pytest.raises(Exception, match="outside its domain"):
        _hist(spark.createDataFrame([(1, "c", score)], "id int, city string, score double")).collect()


def test_rfm_equals_windows_on_driver_data(spark):
    from quayside.registry import Chain
    dim = Chain(spark, "/root/testdata/sf0.01").gold["dim_customers"]
    got = {r["customer_id"]: (r["recency_score"], r["frequency_score"], r["monetary_score"]) for r in dim.collect()}
    base = dim.select(F.col("customer_id").alias("id"), "days_since_last_order", "total_orders", "lifetime_revenue")
    want = {}
    for i, key in enumerate([SortKey.asc("days_since_last_order", nulls_last=True), SortKey.desc("total_orders"), SortKey.desc("lifetime_revenue")]):
        for r in window_ranks(base, key, {"t": ("ntile", 5)}).collect():
            want.setdefault(r["id"], [None] * 3)[i] = r["t"]
    assert got == {k: tuple(v) for k, v in want.items()}
