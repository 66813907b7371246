"""Physical-plan properties the design relies on."""

import os

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from quayside.operators.ranks import SortKey, global_ranks
from quayside.plans import dashboard as D
from quayside.plans import gold as G
from quayside.registry import QUERIES, Chain
from quayside.registry import SILVER_ORDER as S_NAMES
from quayside.sources import tpch


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(tpch.lines(tpch.Tables(spark, SF001)))
    partial = p.find("Partial")
    assert "WindowGroupLimit" in p and partial > p.find("Exchange hashpartitioning")  # partial is below it


def test_scan_prunes_columns_and_pushes_filters(spark):
    t = tpch.Tables(spark, SF001)
    df = t.lineitem.where(F.col("l_shipdate") < F.lit("1998-01-01").cast("timestamp_ntz")).select("l_orderkey")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(l_shipdate), LessThan(l_shipdate" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_shipdate:timestamp_ntz>" in p


def test_restaurant_ranks_run_on_score_histograms(spark):
    c = Chain(spark, SF001)
    p = plan(c.gold["agg_restaurant_performance"])
    # windows see one row per (city, score) / per score, not one row per restaurant
    assert "HashAggregate(keys=[city" in p and "dense_rank" in p and "percent_rank" not in p


def test_scaled_ranks_do_not_window_all_rows_in_one_partition(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("id"), (F.col("id") % 7).alias("k"))
    out = global_ranks(df, [SortKey.desc("k")], ["id"], {"nt": ("ntile", 5)}, buckets=8)
    p = plan(out)
    assert "ntile" not in p                   # ntile comes from global row numbers
    assert "BroadcastHashJoin" in p           # per-bucket offsets, one row per bucket
    assert "hashpartitioning(_b" in p         # rows are ranked inside their bucket


def test_top_k_uses_take_ordered(spark):
    c = Chain(spark, SF001)
    assert "TakeOrderedAndProject" in plan(D.churn_risk(c.gold["dim_customers"]))


HEAVY = ["restaurant_performance", "dim_restaurants", "dim_customers", "daily_city_metrics", "headline_kpis", "cuisine_revenue",
         "ri_quarantine", "customer_cohorts"]


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("QUAYSIDE_FULL_ORACLE") else HEAVY)
def test_no_query_derives_the_lines_again_and_again(spark, name):
    """Driver tables that a query reads more than once are read from a stored frame."""
    text = QUERIES[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in text.split("FileScan parquet")[1:] if "lineitem.parquet" in x.split("ReadSchema")[0]]
    assert len(scans) <= 2
    assert "Expand" not in text


def test_gold_frames_are_built_on_demand_and_lazy(spark):
    c = Chain(spark, SF001)
    for name in S_NAMES:
        c.kept[name]                          # stored silver tables: the only jobs
    sc = spark.sparkContext
    sc.setJobGroup("lazy-gold", "builders")
    silver = {n: c.kept[n] for n in S_NAMES}
    frames = G.GoldFrames(silver, as_of="2002-01-01")
    assert [frames[n] for n in frames] and list(sc.statusTracker().getJobIdsForGroup("lazy-gold")) == []
    sc.setJobGroup("", "")


def test_hot_dates_are_split_by_the_partitioned_write(spark):
    df = spark.range(100).selectExpr("id", "date'2024-01-01' as d").hint("rebalance", F.col("d"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)


def test_aggregates_combine_map_side(spark):
    c = Chain(spark, SF001)
    p = plan(c.gold["agg_daily_city_metrics"])
    assert "partial_count" in p and "partial_sum" in p
