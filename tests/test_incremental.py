"""Incremental layers, co-located joins, pruning, unreadable rows and the stateful stream."""

import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import SF001
from quayside import contracts as K
from quayside import registry_ops as R
from quayside.plans import colocated as CO
from quayside.plans import gold as G
from quayside.plans import incremental as IN
from quayside.registry import AS_OF, ALL_QUERIES, Chain
from quayside.session import scratch_path
from quayside.sources import landing as L
from quayside.streaming.incremental import run_incremental_bronze


def plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def world(spark):
    root, db = scratch_path(spark, "tests", uuid.uuid4().hex), f"qs_test_{uuid.uuid4().hex[:8]}"
    yield R.incremental_layers(spark, SF001, root, db)
    spark.sql(f"DROP DATABASE {db} CASCADE")


def same(a, b):
    cols = [c for c in b.columns if not c.endswith("_loaded_at")]
    assert set(cols) <= set(a.columns)
    x, y = a.select(cols), b.select(cols)
    assert x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


def test_two_increments_equal_a_full_rebuild(spark, world):
    c = Chain(spark, SF001)
    same(world.silver.read(), c.silver["orders"])
    same(world.fact.read(), c.gold["fact_orders"])
    same(world.daily.read(), c.gold["agg_daily_city_metrics"])
    same(world.revenue_summary(), c.gold["agg_revenue_summary"])


def test_other_months_keep_their_files_and_a_replay_changes_nothing(spark, world):
    tables = (world.silver, world.fact, world.daily, world.monthly)
    before = [set(spark.table(t.name).inputFiles()) for t in tables]
    orders = Chain(spark, SF001).bronze["orders"]
    increment = orders.where("order_placed_at like '1996-03-1%'")
    months = world.apply(increment)
    assert months == [(1996, 3)]
    for t, old in zip(tables, before, strict=True):
        now = set(spark.table(t.name).inputFiles())
        assert old != now and {f.split("/order_year=")[1].rsplit("/", 1)[0] for f in old ^ now} == {"1996/order_month=3"}
    test_two_increments_equal_a_full_rebuild(spark, world)
    assert world.apply(increment.limit(0)) == []


def test_a_month_that_loses_all_rows_goes(spark):
    def row(i, day, **more):
        return {"order_id": str(i), "customer_id": "c", "restaurant_id": "r", "order_placed_at": day, "total_amount": 5.0,
                "order_status": "Delivered", **more}

    from helpers import frame
    db = f"qs_test_{uuid.uuid4().hex[:8]}"
    customers = frame(spark, "customers", [{"customer_id": "c"}]).withColumns({k: F.lit("x") for k in ("full_name", "customer_segment")})
    restaurants = frame(spark, "restaurants", [{"restaurant_id": "r"}]).withColumns(
        {"cuisines_list": F.array(F.lit("x")), "price_tier": F.lit("x"), "rating_tier": F.lit("x")})
    deliveries = frame(spark, "deliveries", []).withColumn("delivery_sla_status", F.lit("x"))
    w = IN.IncrementalGold(spark, db, scratch_path(spark, "tests", uuid.uuid4().hex), customers, restaurants, deliveries, AS_OF)
    w.build(frame(spark, "orders", [row(1, "2001-01-05T10:00:00"), row(2, "2001-02-05T10:00:00"), row(3, None)]), 4)
    months = w.apply(frame(spark, "orders", [row(1, "2001-02-07T10:00:00")]))
    assert sorted(months) == [(2001, 1), (2001, 2)]
    assert sorted((r.order_id, r.order_month) for r in w.fact.read().collect()) == [("1", 2), ("2", 2), ("3", None)]
    # without a date, then with an unknown customer: the row leaves its month, then all months
    w.apply(frame(spark, "orders", [row(2, None)]))
    w.apply(frame(spark, "orders", [row(3, None, customer_id="nobody")]))
    assert sorted((r.order_id, r.order_month) for r in w.fact.read().collect()) == [("1", 2), ("2", None)]
    assert w.bronze.read().count() == 3 and [r.total_orders for r in w.monthly.read().where("order_month = 2").collect()] == [1]
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_bucketed_join_has_no_exchange_on_order_id(spark):
    c, names = Chain(spark, SF001), [f"co_{uuid.uuid4().hex[:8]}" for _ in range(2)]
    held = [CO.store_bucketed(df, n, ["order_id"], 8) for df, n in zip((c.kept["orders"], G.first_delivery(c.kept["deliveries"])), names, strict=True)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = CO.colocated_fact(held[0], c.kept["customers"], c.kept["restaurants"], held[1], as_of=AS_OF)
        p = plan(fact)
        assert "hashpartitioning(order_id" not in p and "hashpartitioning(restaurant_id" in p and "Bucketed: true" in p
        same(fact, c.gold["fact_orders"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for n in names:
            spark.sql(f"DROP TABLE {n}")


def test_months_prune_the_fact_at_run_time(spark):
    assert "dynamicpruning" in plan(ALL_QUERIES["pruned_months"](spark, SF001))


@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_unreadable_lines_are_kept_as_text(spark, fmt):
    schema = "order_id string, total_amount double, num_items int"
    lines = {"json": ['{"order_id":"1","total_amount":2.5,"num_items":3}', '{"order_id":"2","total_amount":', "nonsense",
                      '{"order_id":"4","total_amount":"x"}', '{"order_id":"5"}'],
             "csv": ["order_id,total_amount,num_items", "1,2.5,3", "2,abc,1", "3,1.5", "5,,"]}[fmt]
    path = scratch_path(spark, "tests", uuid.uuid4().hex)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    struct = spark.createDataFrame([], schema).schema
    good, bad = L.scan_with_rejects(spark, path, struct, fmt)
    assert sorted(tuple(r) for r in good.fillna(0).collect()) == [("1", 2.5, 3), ("5", 0.0, 0)]
    assert sorted(r.order_id for r in good.select("order_id").collect()) == ["1", "5"]
    assert good.count() == 2 and bad.count() == len(lines) - 2 - (fmt == "csv")
    assert {r.raw_text for r in bad.collect()} < set(lines) and bad.where("source_file is null").count() == 0
    with pytest.raises(ValueError):
        L.scan_with_rejects(spark, path, struct, "parquet")


def test_stream_drops_resent_rows_and_counts_late_ones(spark):
    from helpers import frame
    root = tempfile.mkdtemp(prefix="quayside-stream-")
    landing, table, ckpt = (os.path.join(root, p) for p in ("landing", "bronze", "ckpt"))

    def land(*rows):
        frame(spark, "orders", [{"order_id": str(i), "order_placed_at": t, "order_status": s} for i, t, s in rows]).coalesce(1) \
            .write.mode("append").parquet(landing)

    seen = []
    args = dict(resend_window="1 hour", event_time="order_placed_at", progress=seen)
    land((1, "2001-01-01T10:00:00", "Placed"), (2, "2001-01-01T12:00:00", "Placed"), (2, "2001-01-01T12:00:00", "Placed"))
    out = run_incremental_bronze(spark, landing, "orders", table, ckpt, **args)
    assert out.count() == 2
    land((2, "2001-01-01T12:00:00", "Placed"), (3, "2001-01-01T12:30:00", "Placed"), (4, "2000-01-01T00:00:00", "Placed"))
    out = run_incremental_bronze(spark, landing, "orders", table, ckpt, **args)
    assert sorted(r.order_id for r in out.collect()) == ["1", "2", "3"]
    assert seen[1]["late_rows"] == 1 and seen[1]["input_rows"] == 3
    # by arrival no row is late
    out = run_incremental_bronze(spark, landing, "orders", os.path.join(root, "b2"), os.path.join(root, "c2"), resend_window="1 hour")
    assert sorted(r.order_id for r in out.collect()) == ["1", "2", "3", "4"] and K.PRIMARY_KEYS["orders"] == ["order_id"]
