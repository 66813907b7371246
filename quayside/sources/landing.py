"""Landing-zone scans and sinks.

* :func:`scan_contract` reads files with the entity's explicit schema (no
  inference); a missing column reads as NULL, an extra one is ignored.
* :func:`check_not_null` verifies the NOT NULL part of the contract, which
  file readers do not enforce.
* :func:`bronze_enrich` adds load time, source-file lineage and the row hash.
* :func:`write_dataset` is the parquet / csv / json-lines sink.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import contracts as K
from quayside.functions.columns import row_hash
from quayside.session import shuffles_dropped

FORMATS = ("parquet", "csv", "json")


def scan_contract(spark: SparkSession, path: str, entity: str | T.StructType, fmt: str = "parquet",
                  options: dict | None = None) -> DataFrame:
    """Read ``path`` with the entity contract as the schema (column pruning and
    filter pushdown still apply to whatever the caller selects)."""
    schema = K.SCHEMAS[entity] if isinstance(entity, str) else entity
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", "true")
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    return reader.load(path)


CORRUPT = "_corrupt_record"


def scan_with_rejects(spark: SparkSession, path: str, entity: str | T.StructType, fmt: str = "json",
                      options: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """CSV or JSON landing files, one record a line, as (good rows, unreadable rows).

    A line that can't be read as the contract (broken syntax, a value of another type, too
    few or too many fields) isn't loaded with NULLs: it goes to the second frame as
    ``source_file, raw_text``. Every line is parsed whole, so whether it is good doesn't
    hang on the columns that a query uses. Parquet has no such lines.
    """
    if fmt not in ("csv", "json"):
        raise ValueError(f"unreadable rows exist in csv and json landings, not in {fmt!r}")
    schema = K.SCHEMAS[entity] if isinstance(entity, str) else entity
    full = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema.fields], T.StructField(CORRUPT, T.StringType())])
    given = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **(options or {})}
    lines = spark.read.text(path)
    if fmt == "csv":
        lines = lines.where(F.col("value") != ",".join(f.name for f in schema.fields))  # headers
        row = F.from_csv("value", full.simpleString()[len("struct<"):-1].replace(":", " "), given)
    else:
        row = F.from_json("value", full, given)
    read = lines.select(row.alias("row"), "value", F.col("_metadata.file_path").alias("source_file"))
    broken = F.col(f"row.{CORRUPT}").isNotNull() | F.col("row").isNull()
    return (read.where(~broken).select(*[F.col(f"row.`{f.name}`") for f in schema.fields]),
            read.where(broken).select("source_file", F.col("value").alias("raw_text")))


def with_lineage(df: DataFrame, name: str = "_source_file") -> DataFrame:
    """Add the originating file of each row (file-source scans only)."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def bronze_enrich(df: DataFrame, loaded_at: Column | None = None, lineage: bool = True,
                  hash_columns: Sequence[str] | None = None) -> DataFrame:
    """Bronze audit columns: ``_bronze_loaded_at``, ``_source_file``, ``_row_hash``.

    The hash covers ``hash_columns`` (default: every contract column, as
    loaded) joined by ``||``; ``concat_ws`` skips NULLs, so it is a load
    fingerprint, not a change detector (see ``change_classes`` for that).
    """
    cols = list(hash_columns) if hash_columns is not None else list(df.columns)
    out = with_lineage(df) if lineage else df.withColumn("_source_file", F.lit(None).cast("string"))
    return bronze_audit(out, cols, loaded_at)


def bronze_audit(df: DataFrame, hash_columns: Sequence[str], loaded_at: Column | None = None) -> DataFrame:
    """Load time and row hash of rows that carry their ``_source_file``."""
    loaded = F.current_timestamp() if loaded_at is None else loaded_at
    rest = [F.col(f"`{c}`") for c in df.columns if c != "_source_file"]
    return df.select(*rest, loaded.alias("_bronze_loaded_at"), "_source_file", row_hash(hash_columns).alias("_row_hash"))


def check_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Long form (column, null_rows) for the contract's NOT NULL columns (one aggregate)."""
    required = [f.name for f in schema.fields if not f.nullable and f.name in df.columns]
    if not required:
        return df.sparkSession.createDataFrame([], "column string, null_rows bigint")
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    stack = ", ".join(f"'{c}', `{c}`" for c in required)
    return agg.selectExpr(f"stack({len(required)}, {stack}) AS (column, null_rows)")


def packed(fmt: str) -> dict[str, str]:
    """Writer options of stored tables: row hashes are hex digits, which zstd halves and snappy doesn't."""
    return {"compression": "zstd"} if fmt == "parquet" else {}


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None) -> None:
    """Write a dataset as parquet, csv (with header) or json lines; other formats raise."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; use one of {FORMATS}")
    w = df.write.format(fmt).mode(mode).options(**packed(fmt))
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        w.save(path)


def write_landing(df: DataFrame, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """Overwrite a landing dataset and return it read back with its schema."""
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    write_dataset(df, path, fmt)
    return scan_contract(df.sparkSession, path, schema or df.schema, fmt)


def landing_counts(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """Row count per landing dataset: (entity, row_count), one aggregate each."""
    parts = [spark.read.format(fmt).load(p).agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("entity"), "row_count") for name, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
