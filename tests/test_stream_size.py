"""What an upsert and a stream move and remember."""

import glob
import os
import tempfile

import pyarrow.parquet as pq
import pytest

from helpers import frame
from quayside.operators.upsert import merge_upsert
from quayside.registry_ops import land_files
from quayside.streaming import incremental as I


def test_upsert_takes_the_newest_rows_once(spark):
    target = spark.createDataFrame([(1, "a", 0), (None, "b", 0), (3, "c", 0)], "id int, v string, t int")
    source = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (None, "z", 1), (4, "w", 1), (4, "w", 1)], "id int, v string, t int")
    out = merge_upsert(target, source, ["id"], ["t"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(3, "c", 0), (1, "y", 2), (None, "z", 1), (4, "w", 1)], key=str)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1


@pytest.mark.parametrize(("rows", "parts", "files"), [(1000, 7, 4), (1000, 3, 8), (5, 2, 1), (1, 1, 3), (0, 2, 2)])
def test_landed_files_make_two_micro_batches(spark, rows, parts, files):
    path = tempfile.mkdtemp(prefix="quayside-land-") + "/landing"
    land_files(spark.range(0, rows, 1, parts), path, files)
    full = [f for f in glob.glob(f"{path}/*.parquet") if pq.ParquetFile(f).metadata.num_rows]
    assert sum(pq.ParquetFile(f).metadata.num_rows for f in full) == rows
    assert min(rows, files + 1) <= len(full) <= 2 * files


def test_the_stream_remembers_on_disk_and_a_restart_knows_the_rows(spark):
    root = tempfile.mkdtemp(prefix="quayside-state-")
    landing, table, ckpt = (os.path.join(root, p) for p in ("landing", "bronze", "ckpt"))
    before = {k: spark.conf.get(k, None) for k in I.STATE}
    rows = [{"order_id": str(k), "order_status": "Placed"} for k in range(20)]
    for part, n in ((rows[:10], 10), (rows, 20), (rows, 20)):
        frame(spark, "orders", part).write.mode("append").parquet(landing)
        assert I.run_incremental_bronze(spark, landing, "orders", table, ckpt, resend_window="1 hour").count() == n
    assert {k: spark.conf.get(k, None) for k in I.STATE} == before
    with open(f"{ckpt}/offsets/0") as f:
        assert "RocksDBStateStoreProvider" in f.read()
