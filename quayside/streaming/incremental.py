"""Incremental bronze load as a Structured Streaming query.

New landing files of one entity are picked up by a file stream with the entity
contract as schema, enriched with the bronze audit columns and upserted into a
:class:`~quayside.plans.bucketed.BucketedTable` by ``foreachBatch``. The upsert is
idempotent (replaying a micro-batch after a failure gives the same table), and
the stream checkpoint records which files were consumed, so a restart resumes
where it stopped. ``availableNow`` processes everything present and stops,
which suits a scheduled "every 15 minutes" run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.functions.columns import null_safe_row_hash, row_hash
from quayside.plans.bucketed import BucketedTable


ARRIVED = "_arrived_at"
#: The remembered hashes lie on disk with bounded memory for all stores of an executor, not as
#: objects in its heap, and a micro-batch saves what it changed.
_STORE = "spark.sql.streaming.stateStore"
STATE = {f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
         f"{_STORE}.rocksdb.boundedMemoryUsage": "true", f"{_STORE}.rocksdb.maxMemoryUsageMB": "256"}


def bronze_stream(spark: SparkSession, landing_path: str, entity: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, resend_window: str | None = None,
                  event_time: str | None = None) -> DataFrame:
    """Streaming frame of new landing files with the bronze audit columns.

    ``resend_window``: a row that arrives again (same content) within this time of its first
    arrival is dropped before the upsert; what the stream remembers is bounded by it.
    The time is that of arrival, so no row is ever late; with ``event_time`` (a column of
    ISO timestamps) it is the row's own, and rows older than the watermark are dropped and
    counted (:func:`stream_progress`).
    """
    schema = K.SCHEMAS[entity]
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(landing_path)
    cols = [f.name for f in schema.fields]
    out = (raw.withColumn("_bronze_loaded_at", F.current_timestamp())
           .withColumn("_source_file", F.col("_metadata.file_path"))
           .withColumn("_row_hash", null_safe_row_hash(cols) if resend_window else row_hash(cols)))
    if not resend_window:
        return out
    when = F.current_timestamp() if event_time is None else F.col(event_time).cast("timestamp")
    # the remembered hash as 32 bytes
    out = out.withColumn("_row_hash", F.unhex("_row_hash"))
    return (out.withColumn(ARRIVED, when).withWatermark(ARRIVED, resend_window)
            .dropDuplicatesWithinWatermark(["_row_hash"]).drop(ARRIVED).withColumn("_row_hash", row_hash(cols)))


def start_incremental_bronze(spark: SparkSession, landing_path: str, entity: str, table_root: str,
                             checkpoint: str, keys: Sequence[str] | None = None, fmt: str = "parquet",
                             available_now: bool = True, **stream):
    """Start the stream; returns the ``StreamingQuery`` (call ``awaitTermination``).
    ``stream``: further arguments of :func:`bronze_stream`."""
    keys = list(keys or K.PRIMARY_KEYS[entity])
    table = BucketedTable(spark, table_root, keys, fmt=fmt)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # the upsert reads the batch more than once; the stream's state must move once
        batch.persist()
        try:
            if not batch.isEmpty():
                table.merge(batch, ["_bronze_loaded_at"])
        finally:
            batch.unpersist()

    writer = (bronze_stream(spark, landing_path, entity, fmt, **stream).writeStream
              .foreachBatch(upsert).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 minutes")
    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():  # a started stream keeps the settings that it found
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_progress(query) -> dict[str, int]:
    """What the query's batches since its start read, kept from dropping, and dropped as late."""
    out = {"batches": 0, "input_rows": 0, "late_rows": 0}
    for p in query.recentProgress:
        if p["numInputRows"]:
            out["batches"] += 1
        out["input_rows"] += p["numInputRows"]
        out["late_rows"] += sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    return out


def run_incremental_bronze(spark: SparkSession, landing_path: str, entity: str, table_root: str,
                           checkpoint: str, keys: Sequence[str] | None = None, fmt: str = "parquet",
                           progress: list | None = None, **stream) -> DataFrame:
    """Process all landing files not seen yet, then return the bronze table. ``progress``
    gets one :func:`stream_progress` record."""
    q = start_incremental_bronze(spark, landing_path, entity, table_root, checkpoint, keys, fmt, **stream)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    if progress is not None:
        progress.append(stream_progress(q))
    return BucketedTable(spark, table_root, list(keys or K.PRIMARY_KEYS[entity]), fmt=fmt).read()
