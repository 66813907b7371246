import os
import tempfile

from pyspark.sql import functions as F

from helpers import frame
from quayside import contracts as K
from quayside.plans import bronze as B
from quayside.sources import landing as L


def test_run_bronze_isolates_failures_and_routes_loads(spark):
    root = tempfile.mkdtemp(prefix="quayside-bronze-")
    good = os.path.join(root, "landing", "orders")
    L.write_landing(frame(spark, "orders", [{"order_id": "1"}, {"order_id": "2"}]), good, K.ORDERS)
    landings = {"orders": good, "customers": os.path.join(root, "landing", "missing")}
    tables, status = B.run_bronze(spark, landings, os.path.join(root, "bronze"),
                                  loaded_at=F.lit("2024-01-01").cast("timestamp"))
    st = {r["table"]: r for r in status.collect()}
    assert st["orders"]["status"] == "SUCCESS" and st["orders"]["records"] == 2 and st["orders"]["mode"] == "full"
    assert st["customers"]["status"] == "FAILED" and st["customers"]["error"]
    assert set(tables) == {"orders"}
    # a second incremental run upserts: same keys, no duplicates
    out, mode = B.ingest_to_bronze(spark, good, "orders", os.path.join(root, "bronze", "orders"),
                                   load_type="incremental")
    assert mode == "incremental" and out.count() == 2
    assert out.select("_row_hash").distinct().count() == 2
