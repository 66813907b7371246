import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import frame, rows
from quayside import contracts as K
from quayside.functions.columns import null_safe_row_hash, row_hash
from quayside.operators import quality as Q
from quayside.operators.dedup import dedup_latest
from quayside.operators.upsert import change_classes, load_routing, merge_upsert
from quayside.plans import tables as TB
from quayside.sources import landing as L


def _tmp():
    return tempfile.mkdtemp(prefix="quayside-test-")


def test_row_hash_null_collision_and_null_safe_hash(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    h = [r[0] for r in df.select(row_hash(["x", "y", "z"])).collect()]
    assert h[0] == h[1]                                       # concat_ws skips NULLs: collision kept as designed
    s = [r[0] for r in df.select(null_safe_row_hash(["x", "y", "z"])).collect()]
    assert s[0] != s[1]


def test_merge_upsert_cases(spark):
    tgt = spark.createDataFrame([(1, "old", 1), (2, "same", 1)], "id int, v string, t int")
    src = spark.createDataFrame([(1, "new", 2), (3, "ins", 2), (3, "ins-older", 1), (2, "same", 2)],
                                "id int, v string, t int")
    out = rows(merge_upsert(tgt, src, ["id"], ["t"]), "id", "v")
    assert out == [{"id": 1, "v": "new"}, {"id": 2, "v": "same"}, {"id": 3, "v": "ins"}]
    assert rows(merge_upsert(None, src, ["id"], ["t"]), "id", "v")[2]["v"] == "ins"   # empty target
    again = merge_upsert(merge_upsert(tgt, src, ["id"], ["t"]), src, ["id"], ["t"])
    assert rows(again, "id", "v") == out                       # second run leaves content unchanged


def test_change_classes(spark):
    prev = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, "c", "y")], "id int, p string, q string")
    cur = spark.createDataFrame([(1, "a", None), (2, "b", "z"), (4, "d", "w")], "id int, p string, q string")
    out = {r["id"]: r["change_class"] for r in change_classes(prev, cur, ["id"], ["p", "q"]).collect()}
    assert out == {1: "unchanged", 2: "changed", 3: "missing", 4: "new"}


def test_load_routing(spark):
    path = os.path.join(_tmp(), "orders")
    assert load_routing(spark, path, "incremental")["mode"] == "full"       # target absent
    spark.range(3).write.parquet(path)
    r = load_routing(spark, path, "incremental")
    assert r["mode"] == "incremental" and r["merge_keys"] == ["order_id"]
    assert load_routing(spark, path, "full", ["a", "b"])["merge_keys"] == ["a", "b"]
    with pytest.raises(ValueError):
        load_routing(spark, path, "weekly")


def test_contract_scan_lineage_and_not_null(spark):
    root = _tmp()
    df = frame(spark, "orders", [{"order_id": "1", "total_amount": 5.0}, {"order_id": None}])
    L.write_dataset(df.drop("platform"), f"{root}/orders")          # a column missing in the file
    scanned = L.scan_contract(spark, f"{root}/orders", "orders")
    assert scanned.columns == [f.name for f in K.ORDERS.fields]
    assert scanned.where("platform IS NOT NULL").count() == 0
    viol = {r["column"]: r["null_rows"] for r in L.check_not_null(scanned, K.ORDERS).collect()}
    assert viol == {"order_id": 1}
    enriched = L.bronze_enrich(scanned, loaded_at=F.lit("2024-01-01").cast("timestamp"))
    assert enriched.where(F.col("_source_file").contains("orders")).count() == 2
    assert enriched.select("_row_hash").distinct().count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_sinks_roundtrip(spark, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id bigint, s string, d double")
    path = os.path.join(_tmp(), fmt)
    L.write_dataset(df, path, fmt)
    back = L.scan_contract(spark, path, df.schema, fmt)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_sink_rejects_unknown_format(spark):
    with pytest.raises(ValueError):
        L.write_dataset(spark.range(1), os.path.join(_tmp(), "x"), "avro")


def test_snapshot_table_dml(spark):
    t = TB.SnapshotTable(spark, os.path.join(_tmp(), "customers"))
    t.commit(spark.createDataFrame([(1, "US", True, "555"), (2, "UK", True, "556"), (3, "US", None, "557")],
                                   "customer_id bigint, country string, is_active boolean, phone string"))
    t.update({"is_active": False}, (F.col("country") == "US") & (F.col("customer_id") == 3))
    assert rows(t.read(), "customer_id", "is_active")[2]["is_active"] is False
    t.insert(spark.createDataFrame([(4, "IN", None, "558")], t.read().schema))
    t.delete(F.col("is_active") == False)                          # noqa: E712 - SQL comparison
    # a NULL predicate keeps the row (customer 4)
    assert [r["customer_id"] for r in rows(t.read(), "customer_id")] == [1, 2, 4]
    src = spark.createDataFrame([(4, "IN", True, "559"), (5, "FR", True, "560")], t.read().schema)
    t.merge(src, ["customer_id"])
    t.evolve(add=[("loyalty_tier", "string", "country")], rename={"phone": "phone_number"})
    final = t.read()
    assert final.columns == ["customer_id", "country", "loyalty_tier", "is_active", "phone_number"]
    assert [r["phone_number"] for r in rows(final, "customer_id", "phone_number")] == ["555", "556", "559", "560"]
    assert t.versions() == [4, 5]                                   # the last two snapshots stay


def _files(root):
    return {os.path.relpath(os.path.join(d, f), root) for d, _, fs in os.walk(root) for f in fs if f.startswith("part-")}


def test_partitioned_dml_rewrites_only_touched_partitions(spark):
    root = os.path.join(_tmp(), "by_country")
    t = TB.SnapshotTable(spark, root)
    t.commit(spark.createDataFrame([(1, "US", 5), (2, "UK", 6), (3, "US", 7), (4, None, 8), (5, "FR", 9)],
                                   "id bigint, country string, n int"), ["country"])
    before = _files(root)

    def content():
        return sorted(((r["id"], r["country"], r["n"]) for r in t.read().collect()), key=str)

    def untouched(*names):
        return {f for f in _files(root) if f in before and any(f"country={n}/" in f for n in names)} == \
            {f for f in before if any(f"country={n}/" in f for n in names)}

    t.update({"n": 0}, F.col("id") == 3)
    assert content() == [(1, "US", 5), (2, "UK", 6), (3, "US", 0), (4, None, 8), (5, "FR", 9)]
    assert t.partition_columns() == ["country"] and untouched("UK", "FR")
    t.delete(F.col("id") == 5)                                     # the last row of a partition
    assert (5, "FR", 9) not in content() and len(content()) == 4 and untouched("UK")
    assert not any("country=FR/" in f for f in _files(root))
    src = spark.createDataFrame([(1, "DE", 50), (None, "DE", 1), (9, "UK", 2), (9, "UK", 3)], "id bigint, country string, n int")
    for _ in range(3):                                             # replays change nothing; row 1 moves to another partition
        t.merge(src, ["id"], ["n"])
        assert sorted(content(), key=str) == sorted([(1, "DE", 50), (None, "DE", 1), (9, "UK", 3), (2, "UK", 6), (3, "US", 0), (4, None, 8)], key=str)
    t.update({"country": "US"}, F.col("id") == 2)                  # moves into a partition whose rows must stay
    assert (2, "US", 6) in content() and (3, "US", 0) in content() and len(content()) == 6
    assert t.partition_columns() == ["country"] and t.versions() == [1]
    t.evolve(add=[("note", "string", None)])
    assert t.partition_columns() == ["country"] and "note" in t.read().columns


def test_failed_first_write_is_no_table(spark):
    root = os.path.join(_tmp(), "orders")
    os.makedirs(f"{root}/v=00000001")
    assert load_routing(spark, root, "incremental")["mode"] == "full"
    TB.SnapshotTable(spark, root).commit(spark.range(2))
    assert load_routing(spark, root, "incremental")["mode"] == "incremental"


def test_null_key_replay_is_idempotent(spark):
    src = spark.createDataFrame([(None, "a"), (1, "b")], "id int, v string")
    out = None
    for _ in range(3):
        out = merge_upsert(out, src, ["id"], [])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, "a"), (1, "b")], key=str)


def test_change_classes_tell_shifted_separators_and_null_tokens_apart(spark):
    a = spark.createDataFrame([(1, "x||y", "z"), (2, "\\N", "q"), (None, "u", "u")], "id int, p string, q string")
    b = spark.createDataFrame([(1, "x", "y||z"), (2, None, "q"), (None, "u", "u")], "id int, p string, q string")
    assert {r["id"]: r["change_class"] for r in change_classes(a, b, ["id"], ["p", "q"]).collect()} == \
        {1: "changed", 2: "changed", None: "unchanged"}
    assert a.select(null_safe_row_hash(["p", "q"])).intersect(b.select(null_safe_row_hash(["p", "q"]))).count() == 1


def test_a_missing_order_column_raises(spark):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError, match="_bronze_loaded_at"):
        dedup_latest(df, ["id"])
    assert dedup_latest(df, ["id"], optional=["_bronze_loaded_at"]).count() == 1


def test_checkpoint_folder_must_be_shared_off_the_local_master():
    from types import SimpleNamespace

    from quayside import session

    class Conf:
        def get(self, key):
            raise KeyError(key)

    for master, ok in (("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("yarn", False)):
        assert session.is_local(master) == ok
        if not ok:
            fake = SimpleNamespace(sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None), conf=Conf())
            with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
                session.scratch_path(fake, "x")


def test_defaults_and_not_null(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, True, None)], "id bigint, is_active boolean, name string")
    out = rows(TB.apply_defaults(df, {"is_active": True}, ["id", "name"]), "id", "is_active", "_not_null_violation")
    assert out == [{"id": 1, "is_active": True, "_not_null_violation": None},
                   {"id": None, "is_active": True, "_not_null_violation": "id"}]


def test_catalog_ddl_ctas_external(spark):
    db = "qs_test_bronze"
    created = TB.create_tables(spark, db, {"orders": K.ORDERS})
    TB.create_tables(spark, db, {"orders": K.ORDERS})                # idempotent
    assert created == [f"{db}.orders"]
    path = os.path.join(_tmp(), "ext")
    spark.range(5).write.parquet(path)
    ext = TB.register_external(spark, f"{db}.ext_range", path)
    assert ext.count() == 5
    spark.sql(f"DROP TABLE {db}.ext_range")
    assert spark.read.parquet(path).count() == 5                     # external drop keeps the files
    TB.ctas(spark.range(3).withColumn("k", F.col("id") % 2), f"{db}.ctas_range", partition_by=["k"])
    noted = T.StructType([T.StructField("id", T.LongType(), False, {"comment": "the key's id"}), T.StructField("v", T.StringType())])
    sql = TB.ddl_from_schema(f"{db}.noted", noted, "a table", properties={"team": "ops"})
    assert "`id` bigint NOT NULL COMMENT 'the key\\'s id'" in sql
    spark.sql(sql)
    TB.set_properties(spark, f"{db}.noted", {"quality": "silver"})
    details = {r["name"]: r["value"] for r in TB.table_details(spark, f"{db}.noted").collect()}
    assert "quality=silver" in details["Table Properties"] and "team=ops" in details["Table Properties"]
    assert db in {r["database"] for r in TB.schema_listing(spark, "qs_test*").collect()}
    inv = TB.catalog_inventory(spark, [db])
    assert ("noted", "id", "the key's id") in {(r["table"], r["column"], r["comment"]) for r in inv.collect()}
    assert {(r["table"], r["column"]) for r in inv.collect()} >= {("orders", "order_id"), ("ctas_range", "k")}


def test_quality_metrics_status_gate(spark):
    raw = frame(spark, "customers", [
        {"customer_id": "C1", "email": "a@b.com"}, {"customer_id": "C1", "email": "a@b.com"},
        {"customer_id": "C2", "email": "bad"}, {"customer_id": "C3", "email": "c@d.com", "is_active": True}])
    from quayside.plans import silver as S
    checked = S.silver_customers(raw, with_rejects=True)
    m = Q.dq_metrics("customers", raw, checked).first().asDict()
    assert m == {"table": "customers", "input_rows": 4, "output_rows": 2, "duplicates_removed": 1,
                 "nulls_filled": 7, "quarantined": 1, "pass_rate_pct": 50.0}
    assert m["input_rows"] == m["output_rows"] + m["duplicates_removed"] + m["quarantined"]
    st = Q.dq_status(Q.dq_metrics("customers", raw, checked)).first()["status"]
    assert st == "FAIL"
    gate = {r["check"]: r["passed"] for r in
            Q.dq_gate("customers", raw, checked, ["customer_id"]).collect()}
    assert gate == {"min_pass_rate_pct": False, "max_null_pct": True, "max_duplicate_pct": False,
                    "min_row_count": False}
    with pytest.raises(ValueError):
        Q.assert_non_empty(raw.limit(0), "customers")
