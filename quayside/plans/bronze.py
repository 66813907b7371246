"""Bronze ingestion: landing files -> bronze table with audit columns.

``ingest_to_bronze`` reads one entity's landing files with its contract,
adds the audit columns and routes the load: a full overwrite when asked or
when the target does not exist yet, otherwise a keyed upsert (matched keys
take the new row, new keys are inserted). The target is stored by hash bucket of its
key, so an increment rewrites only the buckets that its keys fall into.
"""

from __future__ import annotations

import datetime as _dt
import time
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.operators.quality import assert_non_empty
from quayside.operators.upsert import load_routing
from quayside.plans.bucketed import BucketedTable, bucket_count
from quayside.sources import landing as L


def ingest_to_bronze(spark: SparkSession, landing_path: str, entity: str, target_root: str, *,
                     load_type: str = "full", merge_keys: Sequence[str] | None = None, fmt: str = "parquet",
                     loaded_at: Column | None = None, name: str | None = None) -> tuple[DataFrame, str]:
    """Load one entity; returns (bronze table as read back, mode used). ``name``: the
    table's name in the catalog."""
    route = load_routing(spark, target_root, load_type, merge_keys, entity)
    scanned = L.scan_contract(spark, landing_path, entity, fmt)
    table = BucketedTable(spark, target_root, route["merge_keys"], name, fmt)
    if route["mode"] == "full":  # the file's name moves with the row, load time and hash are added where it is written
        out = table.replace(L.with_lineage(scanned), bucket_count(spark, landing_path),
                            lambda df: L.bronze_audit(df, scanned.columns, loaded_at))
    else:
        out = table.merge(L.bronze_enrich(scanned, loaded_at=loaded_at), ["_bronze_loaded_at"])
    return out, route["mode"]


def load_entities(spark: SparkSession, landings: dict[str, str], target_root: str, *, load_type: str = "full",
                  loaded_at: Column | None = None, fmt: str = "parquet",
                  names: dict[str, str] | None = None) -> tuple[dict[str, DataFrame], list[dict]]:
    """Ingest every entity; one failure does not stop the others. Returns the tables and one
    record per entity: table, status, mode, error, load_date, run_seconds."""
    tables, records = {}, []
    for entity, path in landings.items():
        began, mode, error = time.time(), None, None
        try:
            out, mode = ingest_to_bronze(spark, path, entity, f"{target_root}/{entity}", load_type=load_type,
                                         merge_keys=K.PRIMARY_KEYS.get(entity), fmt=fmt, loaded_at=loaded_at,
                                         name=(names or {}).get(entity))
            assert_non_empty(out, entity)
            tables[entity] = out
            # a number per NOT NULL column
            broken = [r["column"] for r in L.check_not_null(out, K.SCHEMAS[entity]).where("null_rows > 0").collect()]
            if broken:
                raise ValueError(f"{entity}: NULL in NOT NULL columns {broken}")
        except Exception as e:  # noqa: BLE001 - reported in the record
            error = str(e)
        records.append({"table": entity, "status": "FAILED" if error else "SUCCESS", "mode": None if error else mode, "error": error,
                        "load_date": _dt.datetime.now(), "run_seconds": time.time() - began})
    return tables, records


def run_bronze(spark: SparkSession, landings: dict[str, str], target_root: str, *, load_type: str = "full",
               loaded_at: Column | None = None, fmt: str = "parquet") -> tuple[dict[str, DataFrame], DataFrame]:
    """:func:`load_entities` with one status row per entity (table, status, mode, records, error)."""
    tables, records = load_entities(spark, landings, target_root, load_type=load_type, loaded_at=loaded_at, fmt=fmt)
    parts = []
    for r in records:
        if r["error"]:
            count = spark.range(1).select(F.lit(None).cast("bigint").alias("records"))
        else:
            count = tables[r["table"]].agg(F.count(F.lit(1)).alias("records"))
        parts.append(count.select(*[F.lit(r[c]).cast("string").alias(c) for c in ("table", "status", "mode")], "records",
                                  F.lit(r["error"]).cast("string").alias("error")))
    return tables, reduce(DataFrame.unionByName, parts)
