"""Layer runner: bronze -> silver (+ quarantine) -> gold -> dashboard.

Every layer is written to a table directory and read back before the next
layer uses it, so lineage is cut at each layer (a lost executor only re-runs
the current layer) and no lineage is executed more than once. Silver tables
are written once, partitioned by ``_dq_status``: valid rows and quarantined
rows come out of one pass, and readers prune to their partition.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.config import Settings
from quayside.operators import quality as Q
from quayside.plans import bronze as B
from quayside.plans import dashboard as D
from quayside.plans import gold as G
from quayside.plans import silver as S
from quayside.plans.tables import publish
from quayside.session import drop_path, scratch_path, shuffles_dropped
from quayside.sources import landing as L

ENTITIES = ["customers", "restaurants", "orders", "deliveries", "reviews"]
# Tables that are read by month are stored by month.
MONTHS = {"orders": ("order_year", "order_month"), "fact_orders": ("order_year", "order_month")}


def write_table(df: DataFrame, path: str, *, partition_by: list[str] | None = None,
                fmt: str = "parquet", mode: str = "overwrite") -> DataFrame:
    """Write ``df`` to ``path`` and return a frame reading it back."""
    if set(partition_by or ()) - {"_dq_status"}:  # few files per partition value (two of these need no move); a large value is split by AQE
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    w = df.write.format(fmt).mode(mode).options(**L.packed(fmt))
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        w.save(path)
    return df.sparkSession.read.format(fmt).load(path)


@dataclass
class Run:
    spark: SparkSession
    root: str
    as_of: str | None = None
    fmt: str = "parquet"
    tables: dict[str, DataFrame] = field(default_factory=dict)
    audit: list[dict] = field(default_factory=list)
    metrics: dict[str, DataFrame] = field(default_factory=dict)

    settings: Settings | None = None

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def put(self, layer: str, name: str, path: str) -> DataFrame:
        """The written table: read by name from its layer's database when the run has
        settings, else by path."""
        if self.settings is not None:
            df = publish(self.spark, self.settings.table(layer, name), path, self.fmt)
        else:
            df = self.spark.read.format(self.fmt).load(path)
        self.tables[f"{layer}.{name}"] = df
        return df

    def _timed(self, layer: str, task: str, table: str, fn):
        t0 = time.time()
        try:
            out = fn()
            self.audit.append({"layer": layer, "task": task, "table": table, "status": "SUCCESS",
                               "load_date": _dt.datetime.now(), "run_seconds": time.time() - t0})
            return out
        except Exception as e:  # record, then stop the run (no silent success)
            self.audit.append({"layer": layer, "task": task, "table": table, "status": "FAILED",
                               "load_date": _dt.datetime.now(), "run_seconds": time.time() - t0,
                               "error": str(e)})
            raise


class Staged:
    """Steps of one table, each written and read back; a step goes when the next has been made of it."""

    def __init__(self, run: Run, name: str):
        self.run, self.name, self.steps, self.last = run, name, 0, None

    def __call__(self, df: DataFrame) -> DataFrame:
        path = self.run.path("staging", f"{self.name}_{self.steps}")
        out = write_table(df, path, fmt=self.run.fmt)
        self.drop()
        self.steps, self.last = self.steps + 1, path
        return out

    def drop(self) -> None:
        if self.last is not None:
            drop_path(self.run.spark, self.last)
        self.last = None


def _loaded_at(as_of):
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def land_frames(run: Run, frames: Mapping[str, DataFrame]) -> dict[str, str]:
    """Write landing-shaped frames as landing files with their contracts, at the same time; entity -> path."""
    paths = {name: run.path("landing", name) for name in ENTITIES}

    def land(name: str) -> None:
        run._timed("landing", f"land_{name}", name, lambda: L.write_landing(frames[name], paths[name], K.SCHEMAS[name], run.fmt))

    with ThreadPoolExecutor(len(ENTITIES)) as pool:
        list(pool.map(land, ENTITIES))
    return paths


def run_bronze(run: Run, landings: Mapping[str, str], load_type: str = "full") -> dict[str, DataFrame]:
    """Landing files to the bronze tables (contract scan, audit columns, routed load). A table that
    fails or is empty is recorded as FAILED in the audit and doesn't stop the others; the
    layers above need all of them, so ``run_silver`` stops. Returns the loaded tables by entity."""
    names = {n: run.settings.table("bronze", n) for n in ENTITIES} if run.settings is not None else None
    tables, records = B.load_entities(run.spark, {n: landings[n] for n in ENTITIES}, run.path("bronze", "").rstrip("/"),
                                      load_type=load_type, loaded_at=_loaded_at(run.as_of), fmt=run.fmt, names=names)
    out = {}
    for r in records:
        run.audit.append({"layer": "bronze", "task": f"ingest_{r['table']}", **{k: r[k] for k in ("table", "status", "load_date", "run_seconds")},
                          **({"error": r["error"]} if r["error"] else {})})
        if r["status"] == "SUCCESS":
            out[r["table"]] = run.tables[f"bronze.{r['table']}"] = tables[r["table"]]
    return out


def tpch_bronze(run: Run, sf_dir: str, keep_landing: bool = True) -> dict[str, DataFrame]:
    """Driver tables landed as the five entities, then the bronze layer over the landing files.
    The newest copy of each line item is staged for the order and delivery frames until both
    have landed. ``keep_landing=False``: the landing files go once all five tables are loaded."""
    from quayside.sources import tpch
    t = tpch.Tables(run.spark, sf_dir)
    lines = run._timed("landing", "stage_lines", "lines",
                       lambda: write_table(tpch.lines(t), run.path("staging", "lines"), fmt=run.fmt))
    frames = {"customers": tpch.customers(t), "restaurants": tpch.restaurants(t),
              "orders": tpch.orders(t, lines), "deliveries": tpch.deliveries(t, lines), "reviews": tpch.reviews(t)}
    paths = land_frames(run, frames)
    drop_path(run.spark, run.path("staging", "lines"))
    out = run_bronze(run, paths)
    if not keep_landing and len(out) == len(ENTITIES):
        for path in paths.values():
            drop_path(run.spark, path)
    return out


def _observed_metrics(spark: SparkSession, table: str, raw: DataFrame, seen: dict) -> DataFrame:
    """One metrics row from the numbers observed during the write; the input count
    is an aggregate over the (stored) bronze table."""
    m = spark.createDataFrame([(table, int(seen["deduped"]), int(seen["output_rows"]), int(seen["nulls_filled"]))],
                              "table string, _deduped bigint, output_rows bigint, nulls_filled bigint")
    m = m.withColumn("input_rows", raw.agg(F.count(F.lit(1))).scalar())
    return m.select(
        "table", "input_rows", "output_rows",
        (F.col("input_rows") - F.col("_deduped")).alias("duplicates_removed"),
        "nulls_filled",
        (F.col("_deduped") - F.col("output_rows")).alias("quarantined"),
        F.round(F.col("output_rows") / F.greatest(F.col("input_rows"), F.lit(1)) * 100, 2).alias("pass_rate_pct"),
    )


def run_silver(run: Run, bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    missing = [n for n in ENTITIES if n not in bronze]
    if missing:
        raise ValueError(f"bronze tables {missing} were not loaded")
    loaded = _loaded_at(run.as_of)
    silver: dict[str, DataFrame] = {}
    for name in ENTITIES:
        def build(name=name):
            b, newest = bronze[name], Staged(run, f"newest_{name}")
            if name == "orders":
                checked = S.silver_orders(b, silver["customers"], silver["restaurants"], loaded_at=loaded,
                                          with_rejects=True, store=newest)
            elif name == "deliveries":
                checked = S.silver_deliveries(b, silver["orders"], loaded_at=loaded, with_rejects=True, store=newest)
            else:
                checked = getattr(S, f"silver_{name}")(b, loaded_at=loaded, with_rejects=True)
            status = F.when(F.col("_reject_reason").isNull(), "valid").otherwise("quarantine")
            # the counts ride along with the single write (no re-read of the table)
            obs = Observation(f"dq_{name}_{id(run)}")
            observed = checked.withColumn("_dq_status", status).observe(
                obs,
                F.count(F.lit(1)).alias("deduped"),
                F.count_if(F.col("_reject_reason").isNull()).alias("output_rows"),
                F.coalesce(F.sum(F.when(F.col("_reject_reason").isNull(), F.col("_nulls_filled"))),
                           F.lit(0)).cast("bigint").alias("nulls_filled"))
            write_table(observed, run.path("silver", name), partition_by=["_dq_status", *MONTHS.get(name, ())], fmt=run.fmt)
            newest.drop()
            stored = run.put("silver", name, run.path("silver", name))
            run.metrics[name] = _observed_metrics(run.spark, name, b, obs.get)
            valid = stored.where(F.col("_dq_status") == "valid").drop("_dq_status", "_reject_reason",
                                                                      "_nulls_filled")
            run.tables[f"silver.{name}"] = valid
            run.tables[f"quarantine.{name}"] = stored.where(F.col("_dq_status") == "quarantine").drop("_dq_status")
            return valid
        silver[name] = run._timed("silver", f"transform_{name}", name, build)
    return silver


def run_gold(run: Run, silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The gold tables, each written once; later ones read earlier ones from storage."""
    def build(name: str, make) -> DataFrame:
        path = run.path("gold", name)

        def write():
            write_table(make(), path, partition_by=list(MONTHS.get(name, ())) or None, fmt=run.fmt)
            return run.put("gold", name, path)
        return run._timed("gold", f"build_{name}", name, write)

    s, as_of, gold = silver, run.as_of, {}

    joined, base = Staged(run, "fact_orders"), Staged(run, "customer_base")

    makers = {
        "fact_orders": lambda: G.fact_orders(s["orders"], s["customers"], s["restaurants"], G.first_delivery(s["deliveries"]), as_of=as_of, store=joined),
        "dim_customers": lambda: G.dim_customers(s["customers"], s["orders"], s["reviews"], as_of=as_of, store=base),
        "dim_restaurants": lambda: G.dim_restaurants(s["restaurants"], s["orders"], s["reviews"], s["deliveries"], as_of=as_of),
        "agg_daily_city_metrics": lambda: G.daily_city_metrics(gold["fact_orders"], as_of=as_of),
        "agg_restaurant_performance": lambda: G.restaurant_performance(gold["dim_restaurants"], as_of=as_of),
        "agg_customer_cohorts": lambda: G.customer_cohorts(gold["fact_orders"], gold["dim_customers"], as_of=as_of),
        "agg_delivery_sla_report": lambda: G.delivery_sla_report(s["deliveries"], s["orders"], s["restaurants"], as_of=as_of),
        "agg_revenue_summary": lambda: G.revenue_summary(gold["fact_orders"], as_of=as_of),
    }
    for name, make in makers.items():
        gold[name] = build(name, make)
        if name in ("fact_orders", "dim_customers"):
            (joined if name == "fact_orders" else base).drop()
    return gold


def dashboard_queries(gold: dict[str, DataFrame], report_date: str | None = None) -> dict[str, DataFrame]:
    """The 19 dashboard frames. ``report_date`` (optional, off by default) limits
    the order-level queries to orders placed on or before that date."""
    g = dict(gold)
    if report_date is not None:
        g["fact_orders"] = g["fact_orders"].where(F.col("order_date") <= F.lit(report_date).cast("date"))
    return {
        "headline_kpis": D.headline_kpis(g["fact_orders"], g["dim_customers"], g["dim_restaurants"]),
        "revenue_trend": D.revenue_trend(g["agg_revenue_summary"]),
        "payment_breakdown": D.payment_breakdown(g["fact_orders"]),
        "platform_breakdown": D.platform_breakdown(g["fact_orders"]),
        "city_performance": D.city_performance(g["agg_daily_city_metrics"]),
        "city_trend": D.city_trend(g["agg_daily_city_metrics"]),
        "top_restaurants": D.top_restaurants(g["agg_restaurant_performance"]),
        "type_distribution": D.type_distribution(g["dim_restaurants"]),
        "rfm_distribution": D.rfm_distribution(g["dim_customers"]),
        "segment_by_tier": D.segment_by_tier(g["dim_customers"]),
        "cohort_listing": D.cohort_listing(g["agg_customer_cohorts"]),
        "sla_overview": D.sla_overview(g["agg_delivery_sla_report"]),
        "sla_by_city": D.sla_by_city(g["agg_delivery_sla_report"]),
        "sla_by_vehicle": D.sla_by_vehicle(g["agg_delivery_sla_report"]),
        "cuisine_revenue": D.cuisine_revenue(g["fact_orders"]),
        "time_slot_analysis": D.time_slot_analysis(g["fact_orders"]),
        "high_cancel_restaurants": D.high_cancel_restaurants(g["dim_restaurants"]),
        "churn_risk": D.churn_risk(g["dim_customers"]),
        "churn_count": D.churn_count(g["dim_customers"]),
    }


def layer_counts(spark: SparkSession, tables: Mapping[str, DataFrame | str]) -> DataFrame:
    """Row count of every table, and a total row. A table is a frame, a path or a catalog
    name; one that cannot be opened or counted gives ``-1`` and doesn't stop the others.

    Runs one count per table (a number each); the result is a handful of rows.
    """
    rows = []
    for name, table in tables.items():
        layer, _, short = name.partition(".")
        try:
            df = table if isinstance(table, DataFrame) else spark.read.load(table) if "/" in table else spark.table(table)
            n = df.count()
        except Exception:  # noqa: BLE001 - reported as -1
            n = -1
        rows.append((layer, short, n))
    rows.append(("all", "total", sum(n for *_, n in rows if n >= 0)))
    return spark.createDataFrame(rows, "layer string, table_name string, row_count bigint")


def run_pipeline(spark: SparkSession, bronze: Mapping[str, DataFrame], root: str | None = None, *,
                 as_of: str | None = None, fmt: str = "parquet") -> Run:
    """Run silver and gold over ``bronze`` frames, writing under ``root``
    (default: a folder under the session's checkpoint directory)."""
    root = root or scratch_path(spark, "pipeline", _dt.datetime.now().strftime("%Y%m%dT%H%M%S%f"))
    run = Run(spark, root, as_of, fmt)
    silver = run_silver(run, bronze)
    run_gold(run, silver)
    return run


def audit_frame(run: Run) -> DataFrame:
    """The run's audit rows (layer, task, table, status, load date, seconds) with
    ``total_records`` counted from each written table (one aggregate per table)."""
    parts = []
    for a in run.audit:
        key = f"{a['layer']}.{a['table']}"
        base = run.tables.get(key)
        if base is not None and a["status"] == "SUCCESS":
            cnt = base.agg(F.count(F.lit(1)).alias("total_records"))
        else:
            cnt = run.spark.range(1).select(F.lit(None).cast("bigint").alias("total_records"))
        parts.append(cnt.select(F.lit(a["layer"]).alias("layer"), F.lit(a["task"]).alias("task"),
                                F.lit(a["table"]).alias("table_name"), "total_records",
                                F.lit(a["status"]).alias("status"),
                                F.lit(a["load_date"]).cast("timestamp").alias("load_date"),
                                F.lit(float(a["run_seconds"])).alias("run_seconds"),
                                F.lit(a.get("error")).cast("string").alias("error")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def silver_quality_report(run: Run) -> DataFrame:
    """dq metrics of all silver tables with their PASS / WARN / FAIL status."""
    frames = [run.metrics[n] for n in ENTITIES if n in run.metrics]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return Q.dq_status(out)


