import os
import tempfile

from helpers import frame, rows
from quayside.streaming.incremental import run_incremental_bronze


def test_incremental_bronze_upserts_new_files(spark):
    root = tempfile.mkdtemp(prefix="quayside-stream-")
    landing, table, ckpt = (os.path.join(root, p) for p in ("landing", "bronze", "ckpt"))
    first = frame(spark, "orders", [{"order_id": "1", "order_status": "Placed"},
                                    {"order_id": "2", "order_status": "Placed"}])
    first.write.mode("append").parquet(landing)
    out = run_incremental_bronze(spark, landing, "orders", table, ckpt)
    assert rows(out, "order_id", "order_status") == [{"order_id": "1", "order_status": "Placed"},
                                                     {"order_id": "2", "order_status": "Placed"}]
    # a later file updates order 2 and adds order 3; old files are not read again
    frame(spark, "orders", [{"order_id": "2", "order_status": "Delivered"},
                            {"order_id": "3", "order_status": "Placed"}]).write.mode("append").parquet(landing)
    out = run_incremental_bronze(spark, landing, "orders", table, ckpt)
    assert rows(out, "order_id", "order_status") == [{"order_id": "1", "order_status": "Placed"},
                                                     {"order_id": "2", "order_status": "Delivered"},
                                                     {"order_id": "3", "order_status": "Placed"}]
    assert out.where("_source_file IS NULL OR _row_hash IS NULL").count() == 0
    # nothing new: the table stays as it is
    again = run_incremental_bronze(spark, landing, "orders", table, ckpt)
    assert again.count() == 3
