import uuid

from pyspark.sql import functions as F

from helpers import SF001
from quayside.config import get_settings
from quayside.plans import pipeline as P
from quayside.session import scratch_path


def test_layer_run_end_to_end(spark):
    root = scratch_path(spark, "test-run", uuid.uuid4().hex)
    settings = get_settings(spark, "dev", f"qs{uuid.uuid4().hex[:8]}", root=root)
    run = P.Run(spark, root, as_of="2002-01-01", settings=settings)
    bronze = P.tpch_bronze(run, SF001)
    silver = P.run_silver(run, bronze)
    gold = P.run_gold(run, silver)
    assert set(gold) == {"fact_orders", "dim_customers", "dim_restaurants", "agg_daily_city_metrics",
                         "agg_restaurant_performance", "agg_customer_cohorts", "agg_delivery_sla_report",
                         "agg_revenue_summary"}
    # input = output + duplicates removed + quarantined, per silver table
    for r in P.silver_quality_report(run).collect():
        assert r["input_rows"] == r["output_rows"] + r["duplicates_removed"] + r["quarantined"]
        assert r["status"] in ("PASS", "WARN", "FAIL")
    # counts observed during the write equal an aggregate over the stored table
    from quayside.operators import quality as Q
    for name in ["customers", "orders"]:
        stored = spark.table(settings.table("silver", name))
        assert run.metrics[name].first().asDict() == Q.dq_metrics(name, bronze[name], stored).first().asDict()
    # quarantine partitions hold exactly the rejected rows
    q = run.tables["quarantine.orders"]
    assert q.where(F.col("_reject_reason").isNull()).count() == 0
    assert q.count() + silver["orders"].count() == bronze["orders"].count()
    audit = P.audit_frame(run).collect()
    assert all(a["status"] == "SUCCESS" for a in audit)
    assert {a["layer"] for a in audit} == {"landing", "bronze", "silver", "gold"}
    counts = {(r["layer"], r["table_name"]): r["row_count"] for r in P.layer_counts(spark, run.tables).collect()}
    assert counts[("all", "total")] == sum(v for k, v in counts.items() if k[0] != "all")
    # every layer can be read by name
    for layer, name in [("bronze", "orders"), ("silver", "orders"), ("gold", "fact_orders")]:
        assert spark.table(settings.table(layer, name)).count() > 0
    assert bronze["orders"].where("_source_file like '%/landing/orders/%' and _row_hash is not null").count() == bronze["orders"].count()
    broken = P.layer_counts(spark, {"silver.gone": run.path("silver", "gone"), "gold.no_table": "no_such.table", "gold.ok": gold["fact_orders"]})
    assert [r["row_count"] for r in broken.collect()] == [-1, -1, gold["fact_orders"].count(), gold["fact_orders"].count()]
    # an order table is stored by month
    assert gold["fact_orders"].where("order_year = 1996 and order_month = 2").count() == \
        sum(1 for r in gold["fact_orders"].select("order_date").collect() if r[0] and (r[0].year, r[0].month) == (1996, 2))
    dash = P.dashboard_queries(gold)
    assert dash["headline_kpis"].first()["total_orders"] == gold["fact_orders"].count()
    cut = P.dashboard_queries(gold, report_date="1996-12-31")
    n_cut = gold["fact_orders"].where("order_date <= DATE'1996-12-31'").count()
    assert cut["headline_kpis"].first()["total_orders"] == n_cut < gold["fact_orders"].count()
