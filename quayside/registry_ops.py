"""Registered queries for ingestion, sinks, table statements, quality and
scalar operators. Queries that write do so under the session's shared
checkpoint folder (a fresh directory per call) and return the data read back,
so the SQL oracle checks the stored content.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.functions.columns import (bucket, clamp_negative, money, null_safe_row_hash, row_hash, safe_pct,
                                        standardize_text_columns, surrogate_key)
from quayside.operators import distinct as DI
from quayside.operators import quality as Q
from quayside.operators import quantiles as QU
from quayside.operators.dedup import dedup_latest, first_per_key
from quayside.operators.integrity import ri_filter
from quayside.operators.ranks import SortKey, global_ranks
from quayside.operators.upsert import change_classes, merge_upsert
from quayside.plans import bronze as B
from quayside.plans import colocated as CO
from quayside.plans import gold as G
from quayside.plans import incremental as IN
from quayside.plans import pipeline as P
from quayside.plans import silver as S
from quayside.plans import tables as TB
from quayside.plans.bucketed import BucketedTable, add_columns, bucket_count
from quayside.plans.present import present
from quayside.sources import guide as GD
from quayside.sources import landing as L
from quayside.sources import tpch
from quayside.session import scratch_path
from quayside.streaming.incremental import run_incremental_bronze

# Fixed dates of the incremental-load scenarios (inside the data's 1995-2001 range).
CUTOFF = "1998-01-01"
OVERLAP_FROM = "1997-01-01"
MONTH = ("order_year", "order_month")
PREV_EXTRACT_BEFORE = "2000-01-01"
CUR_EXTRACT_FROM = "1995-06-01"
# Landed orders are dealt into files of about this size, half of them a micro-batch.
STREAM_FILE_BYTES = 8 << 20


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, "queries", name, uuid.uuid4().hex)


def _chain(spark, sf_dir):
    from quayside.registry import Chain
    return Chain(spark, sf_dir)


def _q(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(build(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def _contract_cast(df: DataFrame, entity: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in K.SCHEMAS[entity].fields])


# ------------------------------------------------------------------ ingest

def scan_contract_q(spark, sf_dir):
    """Orders landed as parquet with contract types, scanned back with the contract schema."""
    c = _chain(spark, sf_dir)
    path = _scratch(spark, "landing_orders")
    L.write_landing(_contract_cast(c.bronze["orders"], "orders"), path, K.ORDERS)
    return L.scan_contract(spark, path, "orders")


def scan_lineage_q(spark, sf_dir):
    """Every landed row carries its source file; counts per landing dataset."""
    c = _chain(spark, sf_dir)
    path = _scratch(spark, "landing_deliveries")
    L.write_landing(_contract_cast(c.bronze["deliveries"], "deliveries"), path, K.DELIVERIES)
    df = L.with_lineage(L.scan_contract(spark, path, "deliveries"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.count("_source_file").alias("rows_with_source_file"),
                  F.count_distinct("delivery_id").alias("distinct_keys"))


def row_hash_q(spark, sf_dir):
    """SHA-256 of all ``||``-joined columns of each deduplicated line."""
    lines = _chain(spark, sf_dir).lines
    return lines.select("l_orderkey", "l_linenumber", row_hash(lines.columns).alias("_row_hash"))


def _roundtrip(fmt):
    def build(spark, sf_dir):
        daily = _chain(spark, sf_dir).gold["agg_daily_city_metrics"].drop("_gold_loaded_at")
        path = _scratch(spark, f"sink_{fmt}")
        L.write_dataset(daily, path, fmt)
        return L.scan_contract(spark, path, daily.schema, fmt)
    build.__doc__ = f"Daily city metrics written as {fmt} and read back with their schema."
    return build


def landing_counts_q(spark, sf_dir):
    """Write the five entity landings, then count each one back."""
    c = _chain(spark, sf_dir)
    root = _scratch(spark, "landing")
    paths = {}
    for name, df in c.bronze.items():
        paths[name] = f"{root}/{name}"
        L.write_landing(_contract_cast(df, name), paths[name], K.SCHEMAS[name])
    return L.landing_counts(spark, paths)


def _as_of():
    from quayside.registry import AS_OF
    return AS_OF


def _landing(spark, sf_dir, entity, root, chain=None) -> str:
    path = f"{root}/landing/{entity}"
    L.write_landing(_contract_cast((chain or _chain(spark, sf_dir)).bronze[entity], entity), path, K.SCHEMAS[entity])
    return path


def full_load_q(spark, sf_dir):
    """Bronze orders, full load: landing scan + audit columns, written, read back."""
    root = _scratch(spark, "full_load")
    out, _ = B.ingest_to_bronze(spark, _landing(spark, sf_dir, "orders", root), "orders", f"{root}/bronze/orders",
                                load_type="full", loaded_at=F.lit(_as_of()).cast("timestamp"))
    return out.drop("_source_file", "_row_hash", "_bronze_loaded_at")


def _landings(spark, sf_dir, root) -> dict[str, str]:
    c = _chain(spark, sf_dir)  # one for all: the newest lines are stored once
    return {entity: _landing(spark, sf_dir, entity, root, c) for entity in K.SCHEMAS}


def bronze_run_status_q(spark, sf_dir):
    """Bronze run over the five entities: one status row per table with its record count."""
    root = _scratch(spark, "bronze_run")
    _, status = B.run_bronze(spark, _landings(spark, sf_dir, root), f"{root}/bronze",
                             loaded_at=F.lit(_as_of()).cast("timestamp"))
    return status.select("table", "status", "records")


def load_routing_q(spark, sf_dir):
    """Orders ingested twice with load type 'incremental': the first run finds no
    target and loads fully, the second upserts on order_id; the table is unchanged."""
    root = _scratch(spark, "routing")
    landing = _landings(spark, sf_dir, root)["orders"]
    target = f"{root}/bronze/orders"
    first, mode1 = B.ingest_to_bronze(spark, landing, "orders", target, load_type="incremental")
    n1 = first.count()
    second, mode2 = B.ingest_to_bronze(spark, landing, "orders", target, load_type="incremental")
    return second.agg(F.count(F.lit(1)).alias("records"), F.count_distinct("order_id").alias("distinct_keys")) \
        .select(F.lit(mode1).alias("first_mode"), F.lit(mode2).alias("second_mode"),
                F.lit(n1).cast("bigint").alias("first_records"), "records", "distinct_keys")


def merge_upsert_q(spark, sf_dir):
    """Incremental line load: the history before the cutoff, then a one-year-overlap
    increment (raw, with duplicate keys) merged on (order, line). Equals a full rebuild."""
    t = tpch.Tables(spark, sf_dir)
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    table = TB.SnapshotTable(spark, _scratch(spark, "merge_lines"))
    table.commit(dedup_latest(t.lineitem.where(F.col("l_shipdate") < F.lit(CUTOFF).cast("timestamp_ntz")),
                              keys, order))
    return table.merge(_from(t.lineitem, "l_shipdate", OVERLAP_FROM), keys, order)


def _from(df: DataFrame, col: str, day: str) -> DataFrame:
    """Rows from a day on; rows without a date belong here, so that no row is in neither part."""
    when = F.col(col)
    return df.where((when >= F.lit(day).cast(df.schema[col].dataType)) | when.isNull())


def merge_bucketed_q(spark, sf_dir):
    """The line history stored by hash bucket of its key, then the one-year-overlap increment
    merged twice (its buckets are rewritten, the others stay). The increment brings a
    column of its own, NULL for the rows that it doesn't hold."""
    t = tpch.Tables(spark, sf_dir)
    keys, order = ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    table = BucketedTable(spark, _scratch(spark, "merge_bucketed"), keys)
    history = t.lineitem.where(F.col("l_shipdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    table.replace(dedup_latest(history, keys, order), 64)
    increment = _from(t.lineitem, "l_shipdate", OVERLAP_FROM).withColumn("load_id", F.lit("increment"))
    table.merge(increment, order)
    table.merge(increment, order)
    return table.detach()


def alter_table_q(spark, sf_dir):
    """Customers by name, two columns added in the catalog: they read NULL, and no file was
    written or renamed."""
    _, cust, _ = _guide(spark, sf_dir)
    name = _unique("customers_alter")
    before = set(TB.ctas(cust, name, path=_scratch(spark, "customers_alter")).inputFiles())
    add_columns(spark, name, {"loyalty_tier": "string", "loyalty_points": "int"}, {"loyalty_tier": "customer's tier"})
    out = spark.table(name)
    same = set(out.inputFiles()) == before
    spark.sql(f"DROP TABLE {name}")
    return out.withColumn("files_unchanged", F.lit(same))


def merge_replay_q(spark, sf_dir):
    """A table partitioned by return flag: history, then the same increment merged twice. Its
    key (order, marker) is NULL in part and repeats in the increment. Equals one merge."""
    t = tpch.Tables(spark, sf_dir)
    keys, order = ["l_orderkey", "marker"], ["l_shipdate"]
    rows = t.lineitem.withColumn("marker", F.when(F.col("l_linenumber") < 3, F.col("l_linenumber")))
    table = TB.SnapshotTable(spark, _scratch(spark, "merge_replay"))
    table.commit(dedup_latest(rows.where(F.col("l_shipdate") < F.lit(CUTOFF).cast("timestamp_ntz")), keys, order), ["l_returnflag"])
    increment = _from(rows, "l_shipdate", OVERLAP_FROM)
    table.merge(increment, keys, order)
    return table.merge(increment, keys, order)


def change_classes_q(spark, sf_dir):
    """Line versions of an older extract (first copy per key, shipped before 2000)
    against a newer one (latest copy, shipped from mid-1995): new / changed /
    unchanged / missing per (order, line)."""
    t = tpch.Tables(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    prev = first_per_key(t.lineitem.where(F.col("l_shipdate") < F.lit(PREV_EXTRACT_BEFORE).cast("timestamp_ntz")),
                         keys, ["l_shipdate"])
    cur = dedup_latest(_from(t.lineitem, "l_shipdate", CUR_EXTRACT_FROM), keys, ["l_shipdate"])
    compare = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
               "l_returnflag", "l_linestatus", "l_shipdate"]
    return change_classes(prev, cur, keys, compare)


# ---------------------------------------------------------- table statements

def _guide(spark, sf_dir):
    t = tpch.Tables(spark, sf_dir)
    return t, GD.customers_managed(t), GD.sales_orders(t)


def insert_rows_q(spark, sf_dir):
    """Sales orders table created from the lines shipped before the cutoff, then
    the later lines appended with INSERT semantics."""
    _, _, so = _guide(spark, sf_dir)
    table = TB.SnapshotTable(spark, _scratch(spark, "sales_orders"))
    table.commit(so.where(F.col("order_date") < F.lit(CUTOFF).cast("date")))
    return table.insert(_from(so, "order_date", CUTOFF))


def _update_cond():
    return (F.col("country") == "NATION_3") & F.col("email").contains("1")


def update_where_q(spark, sf_dir):
    """UPDATE customers SET is_active = false WHERE country = 'NATION_3' AND email has a 1, on a
    table partitioned by country: the partitions of other countries stay."""
    _, cust, _ = _guide(spark, sf_dir)
    table = TB.SnapshotTable(spark, _scratch(spark, "customers_managed"))
    table.commit(cust, ["country"])
    return table.update({"is_active": False}, _update_cond())


def delete_where_q(spark, sf_dir):
    """The UPDATE above, then DELETE FROM customers WHERE is_active = false, on the partitioned table."""
    _, cust, _ = _guide(spark, sf_dir)
    table = TB.SnapshotTable(spark, _scratch(spark, "customers_managed"))
    table.commit(cust, ["country"])
    table.update({"is_active": False}, _update_cond())
    return table.delete(F.col("is_active") == F.lit(False))


def evolve_schema_q(spark, sf_dir):
    """ADD COLUMN loyalty_tier STRING AFTER country; RENAME COLUMN phone TO phone_number."""
    _, cust, _ = _guide(spark, sf_dir)
    table = TB.SnapshotTable(spark, _scratch(spark, "customers_managed"))
    table.commit(cust)
    return table.evolve(add=[("loyalty_tier", "string", "country")], rename={"phone": "phone_number"})


def apply_defaults_q(spark, sf_dir):
    """DEFAULT true for is_active and NOT NULL first / last name, on customers
    whose activity is unknown (no order yet: activity taken from the first order)."""
    _, cust, _ = _guide(spark, sf_dir)
    raw = cust.withColumn("is_active", F.when(F.col("created_date").isNotNull(), F.col("is_active")))
    return TB.apply_defaults(raw, {"is_active": True}, ["customer_id", "first_name", "last_name"])


def partitioned_write_q(spark, sf_dir):
    """Sales orders written partitioned by order_date (rows of a date together, a large
    date split), read back."""
    _, _, so = _guide(spark, sf_dir)
    path = _scratch(spark, "sales_orders_by_date")
    P.write_table(so, path, partition_by=["order_date"])
    return spark.read.schema(so.schema).parquet(path)


def external_table_q(spark, sf_dir):
    """Files written to a path, then registered as an external table and read by name."""
    _, _, so = _guide(spark, sf_dir)
    path = _scratch(spark, "ext_sales_orders")
    so.write.mode("overwrite").parquet(path)
    name = _unique("ext_sales_orders")
    return _by_name(spark, name, TB.register_external(spark, name, path))


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


def _by_name(spark, name: str, df: DataFrame) -> DataFrame:
    """A scenario's external table as it was read by name; the name goes, the files stay."""
    spark.sql(f"DROP TABLE {name}")
    return df


def _customer_orders(spark, sf_dir):
    _, cust, so = _guide(spark, sf_dir)
    name = _unique("customer_orders")
    return _by_name(spark, name, TB.ctas(GD.customer_orders(cust, so), name, path=_scratch(spark, "customer_orders")))


def ctas_join_q(spark, sf_dir):
    """External CTAS: active customers joined to their orders, read by name."""
    return _customer_orders(spark, sf_dir)


def ctas_aggregate_q(spark, sf_dir):
    """External CTAS: completed revenue per customer over the joined table."""
    name, summary = _unique("revenue_summary"), GD.customer_revenue_summary(_customer_orders(spark, sf_dir))
    return _by_name(spark, name, TB.ctas(summary, name, path=_scratch(spark, "customer_revenue_summary")))


def ctas_managed_q(spark, sf_dir):
    """Managed CTAS of the same summary, overwritten once and read by name."""
    name = _unique("revenue_managed")
    summary = GD.customer_revenue_summary(_customer_orders(spark, sf_dir))
    TB.ctas(summary.limit(0), name)
    out = P.write_table(TB.ctas(summary, name), _scratch(spark, "revenue_managed"))
    spark.sql(f"DROP TABLE {name}")  # with its files
    return out


def _ddl_database(spark, sf_dir) -> str:
    """The five entity tables created twice by DDL from their contracts, then filled by name."""
    db = _unique("qs_ddl")
    TB.create_tables(spark, db, K.SCHEMAS)
    TB.create_tables(spark, db, K.SCHEMAS)
    bronze = _chain(spark, sf_dir).bronze
    for name in K.SCHEMAS:
        _contract_cast(bronze[name], name).write.insertInto(f"{db}.{name}", overwrite=True)
        TB.set_properties(spark, f"{db}.{name}", {"quality": "bronze"})
    return db


def ddl_tables_q(spark, sf_dir):
    """Tables made by DDL: columns, comments of table and database, property and rows of each."""
    db = _ddl_database(spark, sf_dir)
    listed = TB.catalog_inventory(spark, [db]).groupBy("table").agg(F.count(F.lit(1)).alias("columns"))
    about = TB.schema_listing(spark, db).select(F.col("comment").alias("database_comment")).scalar()
    out = None
    for name in K.SCHEMAS:
        lines = TB.table_details(spark, f"{db}.{name}").where("name in ('Provider', 'Comment', 'Table Properties')")

        def line(key, lines=lines):
            return lines.where(F.col("name") == key).select("value").scalar()

        part = (spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table", F.lit(name))
                .withColumns({"provider": line("Provider"), "table_comment": line("Comment"), "database_comment": about,
                              "has_property": line("Table Properties").contains("quality=bronze")}))
        out = part if out is None else out.unionByName(part)
    return _then_drop(spark, out.join(listed, "table"), db)


def _then_drop(spark, df: DataFrame, database: str) -> DataFrame:
    """The result of a scenario whose database goes."""
    out = P.write_table(df, _scratch(spark, "ddl_result"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return out


def catalog_inventory_q(spark, sf_dir):
    """Every column of the tables made by DDL: type, NOT NULL, comment, and its non-NULL rows."""
    db = _ddl_database(spark, sf_dir)
    inv = TB.catalog_inventory(spark, [db]).select("table", "column", "data_type", "nullable", F.coalesce("comment", F.lit("")).alias("comment"))
    counts = None
    for name, schema in K.SCHEMAS.items():
        cols = [f.name for f in schema.fields]
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        part = (spark.table(f"{db}.{name}").agg(*[F.count(c).alias(c) for c in cols])
                .selectExpr(f"'{name}' AS table", f"stack({len(cols)}, {stack}) AS (column, non_null_rows)"))
        counts = part if counts is None else counts.unionByName(part)
    return _then_drop(spark, inv.join(counts, ["table", "column"]), db)


def bronze_ingest_q(spark, sf_dir):
    """Bronze orders from landing files: hash over all columns, load time and the folder of
    the source file of every row."""
    root = _scratch(spark, "bronze_ingest")
    out, mode = B.ingest_to_bronze(spark, _landing(spark, sf_dir, "orders", root), "orders", f"{root}/bronze/orders",
                                   load_type="full", loaded_at=F.lit(_as_of()).cast("timestamp"))
    folder = F.regexp_extract("_source_file", "/landing/([^/]+)/[^/]+$", 1)
    return out.select("order_id", "_row_hash", folder.alias("source_folder"), F.lit(mode).alias("mode"),
                      (F.col("_bronze_loaded_at") == F.lit(_as_of()).cast("timestamp")).alias("loaded_at_ok"))


def assert_non_empty_q(spark, sf_dir):
    """The non-empty check of the bronze frames, and of each cut down to no row: rows and the
    error text."""
    rows = []
    for name, df in _chain(spark, sf_dir).bronze.items():
        for label, frame in ((name, df), (f"{name}_none", df.where(F.lit(False)))):
            try:
                Q.assert_non_empty(frame, label)
                rows.append((label, None))
            except ValueError as e:
                rows.append((label, str(e)))
    return spark.createDataFrame(rows, "table string, error string")


def ri_filter_q(spark, sf_dir):
    """Order keys whose customer and restaurant exist in the silver tables."""
    c = _chain(spark, sf_dir)
    kept = ri_filter(S.conform_orders(c.bronze["orders"]), [(c.kept["customers"], "customer_id"), (c.kept["restaurants"], "restaurant_id")])
    return kept.select("order_id", "customer_id", "restaurant_id")


def global_ranks_q(spark, sf_dir):
    """Ranks over all orders without a one-task window: dates, text with NULLs and hot ties,
    doubles with NaN and NULL, the smallest bigint; both directions."""
    key = F.col("o_orderkey")
    t = tpch.Tables(spark, sf_dir).orders.select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
        F.when(key % 7 != 0, F.col("o_orderpriority")).alias("word"),
        F.when(key % 11 == 0, F.lit(float("nan"))).when(key % 13 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 3 == 0, F.lit(-2 ** 63)).otherwise(F.col("o_custkey")).alias("cust"))
    kinds = {
        "day": (SortKey.asc("day"), SortKey.desc("day"), ("rank",)), "word": (SortKey.asc("word", nulls_last=True), SortKey.desc("word"), ("dense_rank",)),
        "price": (SortKey.asc("price"), SortKey.desc("price", nulls_last=False), ("row_number",)),
        "cust": (SortKey.asc("cust"), SortKey.desc("cust"), ("ntile", 5)),
    }
    out = t.select("o_orderkey")
    for name, (up, down, kind) in kinds.items():
        for k, end in ((up, "asc"), (down, "desc")):
            r = global_ranks(t.select("o_orderkey", name), [k], ["o_orderkey"], {f"{name}_{end}": kind})
            out = out.join(r.drop(name), "o_orderkey")
    return out


# ------------------------------------------------- incremental layers, stream

def order_increments(orders: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(history, first, second increment) of landed orders. In the history one month has wrong
    amounts and half of another is dated a month early; the increments bring the right rows
    and all later orders, so after both the table holds ``orders``."""
    month, id_ = F.substring("order_placed_at", 1, 7), F.col("order_id").cast("bigint")
    wrong, moved = month == "1997-05", (month == "1996-02") & (id_ % 2 == 0)
    history = orders.where(month < "1998-01").withColumns({
        "total_amount": F.when(wrong, F.col("total_amount") + 1).otherwise(F.col("total_amount")),
        "order_placed_at": F.when(moved, F.concat(F.lit("1996-01"), F.substring("order_placed_at", 8, 30)))
                            .otherwise(F.col("order_placed_at"))})
    first = orders.where(wrong | (month >= "1998-01") & (month < "1999-01"))
    second = orders.where(moved | (month >= "1999-01") | month.isNull())
    return history, first, second


def incremental_layers(spark, sf_dir, root: str, database: str) -> IN.IncrementalGold:
    """Layers built from the history, then two increments of orders."""
    c = _chain(spark, sf_dir)
    # the orders are landed once; the silver tables read them there
    orders = c.bronze.put("orders", P.write_table(c.bronze["orders"], f"{root}/landed_orders"))
    first = G.first_delivery(c.silver["deliveries"].select("delivery_id", "order_id", *G.FACT_DELIVERY))
    delivered = P.write_table(first, f"{root}/first_deliveries")
    layers = IN.IncrementalGold(spark, database, f"{root}/bronze", c.kept["customers"], c.kept["restaurants"], delivered, _as_of())
    history, *increments = order_increments(orders)
    layers.build(history, 32)
    for i in increments:
        layers.apply(i)
    return layers


def incremental_gold_q(spark, sf_dir):
    """Daily city metrics after a full load of an older state and two increments of orders that
    recompute their months only."""
    root, db = _scratch(spark, "incremental_gold"), _unique("qs_incremental")
    out = P.write_table(incremental_layers(spark, sf_dir, root, db).daily.read(), f"{root}/out")
    spark.sql(f"DROP DATABASE {db} CASCADE")
    return out


def land_files(df: DataFrame, path: str, files: int) -> None:
    """Append ``df`` to a landing folder as more than ``files`` and at most twice as many files
    (fewer rows than that: one each). A task cuts its rows into files as it writes
    them, so no row moves."""
    tasks = max(1, files // 2)  # each may end with a short file
    df = df.coalesce(tasks)
    rows = df.count()  # a number
    df.write.mode("append").option("maxRecordsPerFile", max(1, -(-rows // max(files + 1, 2 * files - tasks)))).options(**L.packed("parquet")).parquet(path)


def stream_bronze_q(spark, sf_dir):
    """Bronze orders by stream: two micro-batches, a restart from the checkpoint, then further
    files that also send a third of the earlier rows again."""
    root = _scratch(spark, "stream_bronze")
    orders = P.write_table(_contract_cast(_chain(spark, sf_dir).bronze["orders"], "orders"), f"{root}/orders")
    key = F.col("order_id").cast("bigint")
    where = {k: f"{root}/{k}" for k in ("landing", "bronze", "checkpoint")}
    args = (spark, where["landing"], "orders", where["bronze"], where["checkpoint"])
    seen: list[dict] = []
    files = bucket_count(spark, f"{root}/orders", STREAM_FILE_BYTES, 1)  # a micro-batch is read by several tasks
    for part in (orders.where(key % 2 == 0), orders.where((key % 2 == 1) | (key % 3 == 0))):
        land_files(part, where["landing"], files)
        out = run_incremental_bronze(*args, max_files_per_trigger=files, resend_window="1 hour", progress=seen)
    late, batches = sum(p["late_rows"] for p in seen), min(p["batches"] for p in seen)
    return out.drop("_source_file", "_row_hash", "_bronze_loaded_at").withColumns(
        {"late_rows": F.lit(late).cast("bigint"), "several_batches": F.lit(batches > 1)})


# ------------------------------------------------- roll-ups, stored layouts

def distinct_rollup_q(spark, sf_dir):
    """Exact distinct customers and restaurants by day, month and in total, from one pass of
    the fact: bitmaps over dense ids, merged level by level."""
    c, root = _chain(spark, sf_dir), _scratch(spark, "distinct_rollup")

    def store(name, df):
        return P.write_table(df, f"{root}/{name}")

    ids = {k: store(k, DI.dense_ids(c.kept[t], k)) for t, k in (("customers", "customer_id"), ("restaurants", "restaurant_id"))}
    fact = c.gold["fact_orders"].select("order_date", "order_year", "order_month", "customer_id", "restaurant_id")
    levels = [["order_year", "order_month", "order_date"], ["order_year", "order_month"], []]
    found = DI.distinct_rollup(fact, levels, {"unique_customers": "customer_id", "active_restaurants": "restaurant_id"}, ids, store)
    out = None
    for level, keys, counts in zip(("day", "month", "total"), levels, found, strict=True):
        part = counts.select(F.lit(level).alias("level"), *[
            (F.col(k) if k in keys else F.lit(None)).cast("string").alias(k) for k in levels[0]], "unique_customers", "active_restaurants")
        out = part if out is None else out.unionByName(part)
    return out


def median_sketch_q(spark, sf_dir):
    """Median order value of delivered orders by month and in total, from sketches per day
    merged upwards: whether its exact rank lies within the stated bound."""
    c, root = _chain(spark, sf_dir), _scratch(spark, "median_sketch")
    orders = P.write_table(c.kept["orders"].where("is_delivered").select("order_date", "order_year", "order_month", "total_amount"), f"{root}/orders")
    days = P.write_table(QU.sketches(orders, ["order_year", "order_month", "order_date"], "total_amount"), f"{root}/days")
    months = P.write_table(QU.merge_sketches(days, ["order_year", "order_month"]), f"{root}/months")
    out = None
    for level, keys in (("month", ["order_year", "order_month"]), ("total", [])):
        held = months if keys else QU.merge_sketches(months, [])
        answers = held.select(*keys, QU.quantile().alias("median"))
        part = QU.rank_check(orders, answers, keys, "total_amount", "median")
        part = part.select(F.lit(level).alias("level"), *[(F.col(k) if keys else F.lit(None)).cast("string").alias(k)
                                                          for k in ("order_year", "order_month")], "n", "within_bound")
        out = part if out is None else out.unionByName(part)
    return out


def fact_bucketed_q(spark, sf_dir):
    """The order fact from orders and first deliveries that are stored in the same buckets:
    their join needs no exchange on order_id."""
    c, root = _chain(spark, sf_dir), _scratch(spark, "fact_bucketed")
    first = G.first_delivery(c.silver["deliveries"].select("delivery_id", "order_id", *G.FACT_DELIVERY))
    frames = {"orders": c.kept["orders"], "deliveries": first}
    names = {k: _unique(f"co_{k}") for k in frames}
    held = {k: CO.store_bucketed(df, names[k], ["order_id"], 16, f"{root}/{k}") for k, df in frames.items()}
    out = CO.colocated_fact(held["orders"], c.kept["customers"], c.kept["restaurants"], held["deliveries"], as_of=_as_of())
    out.schema  # resolved: the files stay when the names go
    for name in names.values():
        spark.sql(f"DROP TABLE {name}")
    return out


def pruned_months_q(spark, sf_dir):
    """GMV per city in the months whose GMV grew by over 10 %: the month list prunes the
    partitions of the fact while the query runs."""
    c, root = _chain(spark, sf_dir), _scratch(spark, "pruned_months")
    fact = P.write_table(c.gold["fact_orders"].select("order_id", "customer_city", "total_amount", "is_delivered", *MONTH),
                         f"{root}/fact", partition_by=list(MONTH))
    months = P.write_table(c.gold["agg_revenue_summary"].select(*MONTH, "gmv_growth_pct"), f"{root}/months")
    grown = months.where("gmv_growth_pct > 10").select(*MONTH)
    return (fact.join(grown, list(MONTH)).where("is_delivered").groupBy("customer_city", *MONTH)
            .agg(F.count("order_id").alias("orders"), F.round(F.sum(money("total_amount")), 2).cast("double").alias("gmv")))


def landing_corrupt_q(spark, sf_dir):
    """Orders landed as JSON lines, every 97th order cut in the middle and every 89th with a
    text for its amount: good orders and the raw text of the others, by key."""
    c, path = _chain(spark, sf_dir), f"{_scratch(spark, 'landing_corrupt')}/orders"
    orders = _contract_cast(c.bronze["orders"], "orders")
    line = F.to_json(F.struct(*orders.columns))
    broken = (F.when(F.col("order_id") % 97 == 0, F.expr("substr(line, 1, cast(length(line) / 2 as int))"))
              .when(F.col("order_id") % 89 == 0, F.regexp_replace("line", '"total_amount":', '"total_amount":"x",\n"was":'.replace("\n", "")))
              .otherwise(F.col("line")))
    orders.select("order_id", line.alias("line")).select(broken.alias("value")).write.text(path)
    good, bad = L.scan_with_rejects(spark, path, "orders", "json")
    key = F.regexp_extract("raw_text", '"order_id":"?([0-9]+)', 1).cast("bigint")
    return good.select(F.col("order_id").cast("bigint").alias("order_id"), F.lit("good").alias("landed"), "total_amount").unionByName(
        bad.select(key.alias("order_id"), F.lit("bad").alias("landed"), F.lit(None).cast("double").alias("total_amount")))


# ------------------------------------------------------------------ quality

def _checked(c) -> dict[str, DataFrame]:
    """Silver frames with their rejects. Those that others look keys up in are written once:
    their valid rows are the silver table."""
    b, valid = c.bronze, F.col("_reject_reason").isNull()

    def held(name: str, *parents: DataFrame) -> DataFrame:
        return c.stored(f"checked_{name}", getattr(S, f"silver_{name}")(b[name], *parents, with_rejects=True))

    customers, restaurants, _ = c.together(lambda: held("customers"), lambda: held("restaurants"), lambda: c.stored("lines", c.lines))
    orders = held("orders", customers.where(valid), restaurants.where(valid))
    return {
        "customers": customers,
        "restaurants": restaurants,
        "orders": orders,
        "deliveries": S.silver_deliveries(b["deliveries"], orders.where(valid), with_rejects=True),
        "reviews": S.silver_reviews(b["reviews"], with_rejects=True),
    }


def _metrics(spark, sf_dir) -> DataFrame:
    c = _chain(spark, sf_dir)
    out = None
    for name, checked in _checked(c).items():
        m = Q.dq_metrics(name, c.bronze[name], checked)
        out = m if out is None else out.unionByName(m)
    return out


def quarantine_report_q(spark, sf_dir):
    """Quarantined rows per silver table and reject reason."""
    c = _chain(spark, sf_dir)
    out = None
    for name, checked in _checked(c).items():
        part = (checked.where(F.col("_reject_reason").isNotNull())
                .groupBy(F.col("_reject_reason").alias("reason")).agg(F.count(F.lit(1)).alias("rows"))
                .withColumn("table", F.lit(name)))
        out = part if out is None else out.unionByName(part)
    return out


def dq_metrics_q(spark, sf_dir):
    """Input, output, duplicates removed, nulls filled, quarantined and pass rate per silver table."""
    return _metrics(spark, sf_dir)


def dq_status_q(spark, sf_dir):
    """PASS / WARN / FAIL per silver table from its pass rate."""
    return Q.dq_status(_metrics(spark, sf_dir)).select("table", "pass_rate_pct", "status")


def dq_gate_q(spark, sf_dir):
    """Threshold gate per silver table: pass rate, key null %, duplicate %, minimum rows."""
    c = _chain(spark, sf_dir)
    out = None
    for name, checked in _checked(c).items():
        g = Q.dq_gate(name, c.bronze[name], checked, K.PRIMARY_KEYS[name])
        out = g if out is None else out.unionByName(g)
    return out


def layer_counts_q(spark, sf_dir):
    """Row counts of the bronze, silver and gold tables written by a layer run from landing
    files, of one that was never written (-1), and their total."""
    run = P.Run(spark, _scratch(spark, "pipeline"), _as_of())
    P.run_gold(run, P.run_silver(run, P.tpch_bronze(run, sf_dir, keep_landing=False)))
    tables = {k: v for k, v in run.tables.items() if k.split(".")[0] in ("bronze", "silver", "gold")}
    tables["gold.never_written"] = run.path("gold", "never_written")
    return P.layer_counts(spark, tables)


def run_metrics_q(spark, sf_dir):
    """Full layer run (silver + quarantine, gold tables written under the checkpoint
    folder); audit rows per task with status and the written record count."""
    c = _chain(spark, sf_dir)
    run = P.run_pipeline(spark, c.bronze, _scratch(spark, "pipeline"), as_of=_as_of())
    return P.audit_frame(run).select("layer", "task", "table_name", "status", "total_records")


# ---------------------------------------------------------- filters, scalars

def filter_regex_q(spark, sf_dir):
    """Customers whose email fails the address pattern (multi-label domains included)."""
    c = _chain(spark, sf_dir)
    checked = S.silver_customers(c.bronze["customers"], with_rejects=True)
    return checked.where(F.col("_reject_reason") == "invalid_email").select("customer_id", "email", "_reject_reason")


def filter_isin_q(spark, sf_dir):
    """Order counts by status with the delivered / cancelled flags (IN lists)."""
    return _chain(spark, sf_dir).silver["orders"].groupBy("order_status", "is_delivered", "is_cancelled").agg(
        F.count(F.lit(1)).alias("orders"))


def filter_between_q(spark, sf_dir):
    """Review counts by raw rating and its in-range (1..5) value."""
    b = _chain(spark, sf_dir).bronze["reviews"]
    return b.groupBy(F.col("rating").alias("raw_rating")).agg(F.count(F.lit(1)).alias("reviews")).withColumn(
        "rating", F.when(F.col("raw_rating").between(1, 5), F.col("raw_rating")))


def nullify_invalid_q(spark, sf_dir):
    """Delivery ratings outside 1..5 become NULL: counts per raw and cleaned rating."""
    c = _chain(spark, sf_dir)
    raw = c.bronze["deliveries"].select("delivery_id", F.col("delivery_rating").alias("raw_rating"))
    clean = S.conform_deliveries(c.bronze["deliveries"]).select("delivery_id", "delivery_rating")
    return raw.join(clean, "delivery_id").groupBy("raw_rating", "delivery_rating").agg(
        F.count(F.lit(1)).alias("deliveries"))


def clamp_negative_q(spark, sf_dir):
    """Account balances with negatives clamped to 0 (NULL stays NULL)."""
    t = tpch.Tables(spark, sf_dir)
    return t.customer.select("c_custkey", "c_acctbal", clamp_negative("c_acctbal").alias("balance_clamped"))


def safe_pct_q(spark, sf_dir):
    """Per customer, the discounted share of delivered orders; a customer without a
    delivered order has a zero denominator, which counts as 1."""
    c = _chain(spark, sf_dir)
    o = c.kept["orders"].groupBy("customer_id").agg(
        F.count_if(F.col("is_delivered")).alias("delivered_orders"),
        F.count_if(F.col("is_delivered") & F.col("has_discount")).alias("discounted_delivered"))
    base = c.kept["customers"].select("customer_id").join(o, "customer_id", "left")
    return base.select("customer_id", F.coalesce("delivered_orders", F.lit(0)).alias("delivered_orders"),
                       safe_pct(F.coalesce("discounted_delivered", F.lit(0)), F.col("delivered_orders"))
                       .alias("discounted_pct"))


def bucket_battery_q(spark, sf_dir):
    """Row counts per label of every CASE bucket used by the pipeline (long form)."""
    c = _chain(spark, sf_dir)
    s, g = c.kept, c.gold
    parts = [
        (s["customers"], "customer_segment"), (s["restaurants"], "price_tier"), (s["restaurants"], "rating_tier"),
        (s["orders"], "order_time_slot"), (s["deliveries"], "delivery_sla_status"),
        (s["deliveries"], "distance_bucket"), (g["dim_customers"], "rfm_segment"),
        (s["reviews"], "sentiment_label"), (g["agg_restaurant_performance"], "performance_tier"),
    ]
    out = None
    for df, col in parts:
        p = df.groupBy(F.col(col).alias("label")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
            "bucket", F.lit(col))
        out = p if out is None else out.unionByName(p)
    return out


def scalar_battery_q(spark, sf_dir):
    """Text functions over whole conversation turns: trim, initcap, lower, upper,
    length, digit stripping, concat vs concat_ws, split size, sha2, md5."""
    conv = tpch.Tables(spark, sf_dir).conversations
    return conv.select(
        "conv_id", "turn",
        F.length("text").alias("n_chars"),
        F.length(F.trim("text")).alias("n_chars_trimmed"),
        F.sha2(F.initcap(F.trim("text")), 256).alias("initcap_sha"),
        F.sha2(F.lower("text"), 256).alias("lower_sha"),
        F.sha2(F.upper("role"), 256).alias("upper_role_sha"),
        F.regexp_replace("text", r"[^0-9+]", "").alias("digits"),
        F.concat(F.col("role"), F.lit(": "), F.col("text")).isNull().alias("concat_is_null"),
        F.length(F.concat_ws(" | ", "role", F.lit(None).cast("string"), "role")).alias("concat_ws_len"),
        F.size(F.split("text", " ")).alias("n_space_parts"),
        F.md5(F.col("text")).alias("text_md5"),
        F.upper(F.trim("role")).alias("role_upper"),
        F.initcap("role").alias("role_initcap"),
    )


def standardize_text_q(spark, sf_dir):
    """Trim + initcap of restaurant name, city and locality."""
    b = _chain(spark, sf_dir).bronze["restaurants"]
    return standardize_text_columns(b.select("restaurant_id", "name", "city", "locality"),
                                    ["name", "city", "locality"])


def surrogate_key_q(spark, sf_dir):
    """Generated ids ``ORD_`` + 8 hex digits of MD5 for every order key."""
    t = tpch.Tables(spark, sf_dir)
    return t.orders.select("o_orderkey", surrogate_key("ord", F.col("o_orderkey")).alias("order_ref"))


def order_pricing_q(spark, sf_dir):
    """Order totals from their lines: line total, subtotal, discount %, discount, 5 % tax, fee, total."""
    lines = _chain(spark, sf_dir).lines
    qty = F.col("l_quantity").cast("int")
    unit = (money("l_extendedprice") / qty).cast("decimal(18,2)")
    per_line = lines.select("l_orderkey", (unit * qty).cast("decimal(18,2)").alias("line_total"),
                            F.col("l_discount").cast("decimal(4,2)").alias("disc"))
    o = per_line.groupBy("l_orderkey").agg(F.sum("line_total").alias("subtotal"),
                                           (F.max("disc") * 100).alias("discount_pct"),
                                           F.count(F.lit(1)).alias("num_items"))
    discount = F.round(F.col("subtotal") * F.col("discount_pct") / 100, 2)
    fee = (F.col("num_items") * 5).cast("decimal(18,2)")
    o = o.withColumns({"discount_amount": discount, "delivery_fee": fee})
    o = o.withColumn("tax_amount", F.round((F.col("subtotal") - F.col("discount_amount")) * F.lit(K.TAX_RATE).cast("decimal(4,2)"), 2))
    o = o.withColumn("total_amount", F.col("subtotal") - F.col("discount_amount") + F.col("delivery_fee")
                     + F.col("tax_amount"))
    return o.select("l_orderkey", *[F.col(c).cast("double").alias(c) for c in
                                    ["subtotal", "discount_pct", "discount_amount", "delivery_fee", "tax_amount",
                                     "total_amount"]], "num_items")


def delivery_timeline_q(spark, sf_dir):
    """Deliveries of delivered orders: pickup, delivered = pickup + minutes, and the check."""
    c = _chain(spark, sf_dir)
    d = c.kept["deliveries"].join(c.kept["orders"].where(F.col("is_delivered")).select("order_id"), "order_id",
                                    "left_semi")
    mins = F.timestamp_diff("MINUTE", F.col("pickup_timestamp"), F.col("delivered_timestamp"))
    return d.select("delivery_id", "order_id", "pickup_timestamp", "delivered_timestamp", "delivery_time_mins",
                    (mins == F.col("delivery_time_mins")).alias("timeline_consistent"))


def sentiment_label_q(spark, sf_dir):
    """Sentiment derived from the raw review rating: >= 4 Positive, <= 2 Negative, else Neutral."""
    b = _chain(spark, sf_dir).bronze["reviews"]
    return b.select("review_id", "rating", bucket("rating", *K.SENTIMENT).alias("sentiment_from_rating"))


def health_score_q(spark, sf_dir):
    """Restaurant health score with its four inputs."""
    d = _chain(spark, sf_dir).gold["dim_restaurants"]
    return d.select("restaurant_id", "avg_customer_rating", "fulfillment_rate_pct", "sla_compliance_pct",
                    "positive_reviews", "negative_reviews", "restaurant_health_score")


def null_safe_hash_q(spark, sf_dir):
    """Collision-free and plain row hash over all customer contract columns."""
    b = _contract_cast(_chain(spark, sf_dir).bronze["customers"], "customers")
    cols = [f.name for f in K.CUSTOMERS.fields]
    return b.select("customer_id", null_safe_row_hash(cols).alias("_hash"),
                    row_hash(cols).alias("_row_hash"))


OP_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _q(v) for k, v in {
    "scan_contract": scan_contract_q,
    "scan_lineage": scan_lineage_q,
    "row_hash": row_hash_q,
    "sink_parquet_roundtrip": _roundtrip("parquet"),
    "sink_csv_roundtrip": _roundtrip("csv"),
    "sink_json_roundtrip": _roundtrip("json"),
    "landing_counts": landing_counts_q,
    "full_load": full_load_q,
    "bronze_run_status": bronze_run_status_q,
    "load_routing": load_routing_q,
    "merge_upsert": merge_upsert_q,
    "incremental_gold": incremental_gold_q,
    "stream_bronze": stream_bronze_q,
    "distinct_rollup": distinct_rollup_q,
    "median_sketch": median_sketch_q,
    "fact_bucketed": fact_bucketed_q,
    "pruned_months": pruned_months_q,
    "landing_corrupt": landing_corrupt_q,
    "merge_bucketed": merge_bucketed_q,
    "alter_table": alter_table_q,
    "merge_replay": merge_replay_q,
    "bronze_ingest": bronze_ingest_q,
    "assert_non_empty": assert_non_empty_q,
    "ri_filter": ri_filter_q,
    "ddl_tables": ddl_tables_q,
    "catalog_inventory": catalog_inventory_q,
    "ctas_managed": ctas_managed_q,
    "global_ranks": global_ranks_q,
    "change_classes": change_classes_q,
    "insert_rows": insert_rows_q,
    "update_where": update_where_q,
    "delete_where": delete_where_q,
    "evolve_schema": evolve_schema_q,
    "apply_defaults": apply_defaults_q,
    "partitioned_write": partitioned_write_q,
    "external_table": external_table_q,
    "ctas_join": ctas_join_q,
    "ctas_aggregate": ctas_aggregate_q,
    "quarantine_report": quarantine_report_q,
    "dq_metrics": dq_metrics_q,
    "dq_status": dq_status_q,
    "dq_gate": dq_gate_q,
    "layer_counts": layer_counts_q,
    "run_metrics": run_metrics_q,
    "filter_regex": filter_regex_q,
    "filter_isin": filter_isin_q,
    "filter_between": filter_between_q,
    "nullify_invalid": nullify_invalid_q,
    "clamp_negative": clamp_negative_q,
    "safe_pct": safe_pct_q,
    "bucket_battery": bucket_battery_q,
    "scalar_battery": scalar_battery_q,
    "standardize_text": standardize_text_q,
    "surrogate_key": surrogate_key_q,
    "order_pricing": order_pricing_q,
    "delivery_timeline": delivery_timeline_q,
    "sentiment_label": sentiment_label_q,
    "health_score": health_score_q,
    "null_safe_hash": null_safe_hash_q,
}.items()}
