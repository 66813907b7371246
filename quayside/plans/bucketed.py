"""Tables stored by hash bucket of their key: an upsert reads and rewrites its buckets only.

A bucketed table is an external catalog table partitioned by one extra column,
``_bucket_of_<n>`` = ``pmod(xxhash64(keys), n)``. An increment

1. is reduced to its newest row per key and given its bucket numbers,
2. reads the table's rows of those buckets (partition pruning),
3. writes them back with dynamic partition overwrite: Spark stages the new files
   and swaps only the partitions it wrote, every other file stays as it is.

Columns that the table lacks are added to the catalog first (``ALTER TABLE ADD
COLUMNS``, no file is touched); rows that were written before read them as NULL.

The bucket count is fixed by a full load from the bytes that it reads
(:func:`bucket_count`), so a bucket stays a few files however large the table is,
and stands in the column name, so a table is opened again from its files alone.
Readers should hold no file list of a touched bucket across an upsert.
"""

from __future__ import annotations

import hashlib
import re
import threading
from collections.abc import Callable, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.dedup import dedup_latest
from quayside.operators.upsert import merge_upsert, table_exists
from quayside.session import shuffles_dropped
from quayside.sources.landing import packed

PREFIX = "_bucket_of_"
_TURN = threading.RLock()
BUCKET_BYTES = 256 << 20
LEAST_BUCKETS, MOST_BUCKETS = 16, 1 << 16


def bucket_count(spark: SparkSession, path: str, bucket_bytes: int = BUCKET_BYTES, least: int = LEAST_BUCKETS) -> int:
    """Buckets of about ``bucket_bytes`` for the files under ``path``, a power of two."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = at.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(at).getLength()
    return min(max(least, 1 << (size // bucket_bytes).bit_length()), MOST_BUCKETS)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row; equal keys of one type (NULLs too) share it."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@contextmanager
def overwrite_mode(spark: SparkSession, mode: str):
    """``dynamic``: an overwrite replaces only the partitions that it writes; ``static``: all.
    It is a setting of the session, so overwrites of one session take turns."""
    key = "spark.sql.sources.partitionOverwriteMode"
    with _TURN:
        before = spark.conf.get(key)
        spark.conf.set(key, mode)
        try:
            yield
        finally:
            spark.conf.set(key, before)


def add_columns(spark: SparkSession, table: str, columns: dict[str, str], comments: dict[str, str] | None = None) -> None:
    """``ALTER TABLE ... ADD COLUMNS`` of a catalog table: metadata only, old rows read NULL."""
    def column(name: str, kind: str) -> str:
        note = (comments or {}).get(name, "").replace("\\", "\\\\").replace("'", "\\'")
        return f"`{name}` {kind}" + (f" COMMENT '{note}'" if note else "")

    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(column(n, k) for n, k in columns.items())})")


def _last(df: DataFrame, column: str) -> DataFrame:
    return df.select(*[f"`{c}`" for c in df.columns if c != column], column)


class BucketedTable:
    """A keyed table at ``path``, in the catalog as ``name`` (default: made from the path)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], name: str | None = None, fmt: str = "parquet"):
        self.spark, self.path, self.keys, self.fmt = spark, path.rstrip("/"), list(keys), fmt
        self.name = name or f"bucketed_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def exists(self) -> bool:
        return table_exists(self.spark, self.path)

    def _table(self) -> DataFrame:
        """The catalog table, registered from its files where the catalog doesn't know it yet."""
        if not self.spark.catalog.tableExists(self.name):
            if not self.exists():
                raise FileNotFoundError(f"no table at {self.path}")
            # the files of a table whose columns grew differ: their schemas are merged once, here
            merged = self.spark.read.format(self.fmt).option("mergeSchema", "true").load(self.path)
            part = next(c for c in merged.columns if c.startswith(PREFIX))
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema.fields)
            options = "".join(f"OPTIONS ({k} '{v}') " for k, v in packed(self.fmt).items())
            self.spark.sql(f"CREATE TABLE {self.name} ({cols}) USING {self.fmt} {options}PARTITIONED BY ({part}) LOCATION '{self.path}'")
            self.spark.catalog.recoverPartitions(self.name)
        return self.spark.table(self.name)

    def _bucket(self, table: DataFrame) -> tuple[str, int]:
        column = next(c for c in table.columns if c.startswith(PREFIX))
        return column, int(re.sub(r"\D", "", column))

    def read(self) -> DataFrame:
        table = self._table()
        return table.drop(self._bucket(table)[0])

    def replace(self, df: DataFrame, buckets: int, finish: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Full load: ``df`` becomes the table, dealt into ``buckets``. ``finish`` (row by row)
        adds columns to the dealt rows, so that those don't move."""
        column = f"{PREFIX}{buckets}"
        if "." in self.name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name.split('.')[0]}")
        with overwrite_mode(self.spark, "static"), shuffles_dropped(df.sparkSession):
            dealt = df.withColumn(column, bucket_of(self.keys, buckets)).hint("rebalance", F.col(column))
            (_last(finish(dealt) if finish else dealt, column).write.format(self.fmt).mode("overwrite").options(**packed(self.fmt)).partitionBy(column).option("path", self.path).saveAsTable(self.name))
        return self.read()

    def matching(self, source: DataFrame) -> DataFrame:
        """The table's rows whose key is in ``source``; reads its buckets only."""
        table = self._table()
        column, n = self._bucket(table)
        keys = source.select(*[F.col(k).cast(table.schema[k].dataType).alias(f"_k_{k}") for k in self.keys]).distinct()
        keys = keys.withColumn("_b", bucket_of([f"_k_{k}" for k in self.keys], n))
        # at most n numbers
        touched = [r[0] for r in keys.select("_b").distinct().collect()]
        same = reduce(and_, [table[k].eqNullSafe(keys[f"_k_{k}"]) for k in self.keys])
        return table.where(F.col(column).isin(touched)).join(keys, same, "left_semi").drop(column)

    def merge(self, source: DataFrame, order_cols: Sequence[str] = (), buckets: int = LEAST_BUCKETS) -> DataFrame:
        """Upsert on the keys (see :func:`merge_upsert`) that rewrites only the buckets of
        ``source``. A table that doesn't exist yet is made from it."""
        if not self.exists():
            return self.replace(dedup_latest(source, self.keys, order_cols), buckets)
        table = self._table()
        new = {f.name: f.dataType.simpleString() for f in source.schema.fields if f.name not in table.columns}
        if new:
            add_columns(self.spark, self.name, new)
            table = self._table()
        column, n = self._bucket(table)
        given = set(source.columns)
        src = source.select(*[(F.col(f"`{f.name}`") if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
                              for f in table.schema.fields if f.name != column])
        src = src.withColumn(column, bucket_of(self.keys, n))
        # at most n numbers
        touched = [r[0] for r in src.select(column).distinct().collect()]
        if not touched:
            return self.read()
        merged = merge_upsert(table.where(F.col(column).isin(touched)), src, self.keys, order_cols)
        with overwrite_mode(self.spark, "dynamic"), shuffles_dropped(merged.sparkSession):
            (merged.select(*[f"`{c}`" for c in table.columns]).hint("rebalance", F.col(column))
             .write.mode("overwrite").insertInto(self.name))
        return self.read()

    def detach(self) -> DataFrame:
        """Forget the table in the catalog; returns its rows read by path (the files stay)."""
        table = self._table()
        out = self.spark.read.schema(table.schema).format(self.fmt).load(self.path).drop(self._bucket(table)[0])
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        return out
