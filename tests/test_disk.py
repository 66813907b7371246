"""What a layer run holds on disk."""

import glob
import os
import uuid
from concurrent.futures import ThreadPoolExecutor

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import SF001
from quayside.plans import pipeline as P
from quayside.plans.bucketed import BucketedTable
from quayside.session import SHUFFLE_CLEANUP, scratch_path, shuffles_dropped


def _codecs(path: str) -> set[str]:
    metas = [pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/**/*.parquet", recursive=True)]
    return {m.row_group(0).column(0).compression for m in metas if m.num_row_groups}


def _local(path: str) -> str:
    return path.removeprefix("file:")


def test_writes_hold_the_shuffle_cleanup_and_give_it_back(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)

    def hold(_):
        with shuffles_dropped(spark):
            return spark.conf.get(SHUFFLE_CLEANUP)

    with ThreadPoolExecutor(4) as pool:
        assert set(pool.map(hold, range(40))) == {"true"}
    with pytest.raises(ValueError), shuffles_dropped(spark):
        raise ValueError
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_layer_run_drops_what_it_has_consumed(spark):
    run = P.Run(spark, scratch_path(spark, "test-disk", uuid.uuid4().hex), as_of="2002-01-01")
    gold = P.run_gold(run, P.run_silver(run, P.tpch_bronze(run, SF001, keep_landing=False)))
    root = _local(run.root)
    assert not os.listdir(f"{root}/landing") and not os.listdir(f"{root}/staging")
    assert _codecs(f"{root}/bronze") == _codecs(f"{root}/silver") == _codecs(f"{root}/gold") == {"ZSTD"}
    assert gold["fact_orders"].count() == run.tables["silver.orders"].count() > 0
    assert run.tables["bronze.deliveries"].where("_source_file like '%/landing/deliveries/%'").count() > 0


def test_a_merge_keeps_the_codec(spark):
    table = BucketedTable(spark, scratch_path(spark, "test-codec", uuid.uuid4().hex), ["id"])
    table.replace(spark.range(100).withColumn("v", F.lit("a")), 4)
    out = table.merge(spark.range(90, 110).withColumn("v", F.lit("b")))
    assert {r["v"]: r["n"] for r in out.groupBy("v").agg(F.count("id").alias("n")).collect()} == {"a": 90, "b": 20}
    assert _codecs(_local(table.path)) == {"ZSTD"}
