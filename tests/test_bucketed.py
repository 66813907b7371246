"""Bucketed tables: an increment rewrites its buckets only."""

import uuid

import pytest
from pyspark.sql import functions as F

from quayside.plans import tables as TB
from quayside.plans.bucketed import LEAST_BUCKETS, PREFIX, BucketedTable, add_columns, bucket_count
from quayside.session import scratch_path

KEYS = ["k", "part"]


@pytest.fixture
def table(spark):
    t = BucketedTable(spark, scratch_path(spark, "tests", uuid.uuid4().hex), KEYS)
    t.replace(spark.range(400).select(F.col("id").alias("k"), F.lit("a").alias("part"), F.lit(1).alias("v")), 32)
    yield t
    spark.sql(f"DROP TABLE IF EXISTS {t.name}")


def files(t) -> dict[str, set[str]]:
    out: dict[str, set[str]] = {}
    for f in t.spark.table(t.name).inputFiles():
        out.setdefault(f.split(PREFIX)[1].split("/")[0], set()).add(f)
    return out


def rows(df):
    return {(r.k, r.part): tuple(r)[2:] for r in df.collect()}


def test_other_buckets_keep_their_files(spark, table):
    before = files(table)
    out = table.merge(spark.createDataFrame([(5, "a", 50), (1000, "b", 7)], "k bigint, part string, v int"))
    after = files(table)
    changed = {b for b in before if before[b] != after.get(b)}
    assert len(before) == 32 and len(changed) <= 2
    got = rows(out)
    assert len(got) == 401 and got[5, "a"] == (50,) and got[1000, "b"] == (7,) and got[6, "a"] == (1,)


def test_only_touched_buckets_are_read(spark, table):
    plan = spark.table(table.name).where(F.col(f"{PREFIX}32").isin([3, 4]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"{PREFIX}32" in plan.split("PartitionFilters")[1][:80]


def test_new_and_missing_columns(spark, table):
    out = table.merge(spark.createDataFrame([(5, "a", "x", 2.5)], "k int, part string, tag string, w double"))
    got = out.where("k in (5, 6)").select("k", "v", "tag", "w").collect()
    assert sorted(map(tuple, got)) == [(5, None, "x", 2.5), (6, 1, None, None)]


def test_null_keys_and_replay(spark, table):
    inc = spark.createDataFrame([(None, "a", 9), (None, "a", 8), (3, None, 4)], "k bigint, part string, v int")
    table.merge(inc, ["v"])
    got = rows(table.merge(inc, ["v"]))
    assert len(got) == 402 and got[None, "a"] == (9,) and got[3, None] == (4,) and got[3, "a"] == (1,)


def test_empty_increment_changes_nothing(spark, table):
    before = files(table)
    table.merge(spark.createDataFrame([], "k bigint, part string, v int"))
    assert files(table) == before


def test_opened_again_from_its_files(spark, table):
    table.merge(spark.createDataFrame([(5, "a", "x")], "k bigint, part string, tag string"))
    spark.sql(f"DROP TABLE {table.name}")
    again = BucketedTable(spark, table.path, KEYS)
    assert again.exists() and again.read().count() == 400
    got = rows(again.merge(spark.createDataFrame([(7, "a", 70)], "k bigint, part string, v int")).select("k", "part", "v", "tag"))
    assert got[7, "a"] == (70, None) and got[5, "a"] == (None, "x") and len(got) == 400


def test_first_merge_makes_the_table_and_detach_keeps_the_files(spark):
    t = BucketedTable(spark, scratch_path(spark, "tests", uuid.uuid4().hex), ["k"])
    with pytest.raises(FileNotFoundError):
        t.read()
    t.merge(spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k bigint, v int"), ["v"])
    out = t.detach()
    assert sorted(map(tuple, out.collect())) == [(1, 2), (2, 1)] and not spark.catalog.tableExists(t.name)


def test_bucket_count_grows_with_the_bytes(spark, table):
    assert bucket_count(spark, table.path) == LEAST_BUCKETS
    assert bucket_count(spark, table.path, 1 << 8) > LEAST_BUCKETS


def test_add_columns_touches_no_file(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    TB.ctas(spark.range(10), name)
    before = spark.table(name).inputFiles()
    add_columns(spark, name, {"note": "string"}, {"note": "a 'quoted' note"})
    assert spark.table(name).inputFiles() == before and spark.table(name).where("note is null").count() == 10
    assert [c.description for c in spark.catalog.listColumns(name)][1] == "a 'quoted' note"
    spark.sql(f"DROP TABLE {name}")


def test_partitioned_merge_keeps_new_columns(spark):
    t = TB.SnapshotTable(spark, scratch_path(spark, "tests", uuid.uuid4().hex))
    t.commit(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, p string"), ["p"])
    out = t.merge(spark.createDataFrame([(1, "a", "new")], "k bigint, p string, extra string"), ["k"])
    assert {r.k: r.extra for r in out.collect()} == {1: "new", 2: None} and t.partition_columns() == ["p"]


def test_a_full_load_leaves_no_old_bucket(spark, table):
    key = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(key, "dynamic")
    try:
        out = table.replace(spark.createDataFrame([(1, "z", 1)], "k bigint, part string, v int"), 8)
        assert out.count() == 1 and len(files(table)) == 1 and spark.conf.get(key) == "dynamic"
        assert BucketedTable(spark, table.path, KEYS, "again_" + uuid.uuid4().hex[:8]).detach().count() == 1
    finally:
        spark.conf.unset(key)
