"""Table statements over plain Parquet: DDL, CTAS, DML as DataFrame rewrites.

Parquet has no row-level UPDATE / DELETE / MERGE, so a statement is a DataFrame
transform (``update_where``, ``delete_where``, ``merge_upsert``, ``evolve_schema``).
:class:`SnapshotTable` applies it

* to a partitioned table by rewriting only the partitions that hold touched rows
  (Spark's dynamic partition overwrite); the files of all others stay;
* to an unpartitioned table as a new numbered snapshot directory. Readers take the
  newest complete snapshot; the last ``keep`` snapshots stay, older ones go.

Appends add files to the current snapshot.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quayside.operators.upsert import merge_upsert


# ------------------------------------------------------------ transforms

def update_where(df: DataFrame, assignments: dict[str, Column | object], cond: Column) -> DataFrame:
    """``UPDATE t SET c = v WHERE cond``: rows where ``cond`` is TRUE get the new values."""
    hit = F.coalesce(cond, F.lit(False))
    cols = {c: F.when(hit, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c)).cast(df.schema[c].dataType)
            for c, v in assignments.items()}
    return df.withColumns(cols)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """``DELETE FROM t WHERE cond``: a row goes only when ``cond`` is TRUE (NULL keeps it)."""
    return df.where(~F.coalesce(cond, F.lit(False)))


def evolve_schema(df: DataFrame, add: Sequence[tuple[str, str, str | None]] = (),
                  rename: dict[str, str] | None = None) -> DataFrame:
    """``ADD COLUMN name type [AFTER col]`` (typed NULL) and ``RENAME COLUMN``."""
    out = df
    for name, dtype, after in add:
        cols = [F.col(f"`{c}`") for c in out.columns]
        new = F.lit(None).cast(dtype).alias(name)
        if after is None:
            cols.append(new)
        else:
            i = out.columns.index(after)
            cols.insert(i + 1, new)
        out = out.select(*cols)
    if rename:
        out = out.withColumnsRenamed(rename)
    return out


def apply_defaults(df: DataFrame, defaults: dict[str, object], not_null: Sequence[str] = ()) -> DataFrame:
    """Column DEFAULTs for missing values and a NOT NULL check.

    Adds ``_not_null_violation`` (name of the first NOT NULL column that is
    NULL, else NULL) so callers can reject or report such rows.
    """
    out = df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                          for c, v in defaults.items()})
    viol = F.lit(None).cast("string")
    for c in reversed(list(not_null)):
        viol = F.when(F.col(c).isNull(), F.lit(c)).otherwise(viol)
    return out.withColumn("_not_null_violation", viol)


# -------------------------------------------------------- snapshot table

class SnapshotTable:
    """A path-based table: ``root/v=<n>`` snapshot directories, newest wins.

    ``keep``: snapshots that stay after a commit (readers of older ones must be done).
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", keep: int = 2):
        self.spark, self.root, self.fmt, self.keep = spark, root.rstrip("/"), fmt, max(keep, 1)

    def _fs(self):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm

    def _listed(self, complete_only: bool) -> list[int]:
        fs, jvm = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.root)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if not name.startswith("v="):
                continue
            if complete_only and not fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                continue
            out.append(int(name[2:]))
        return sorted(out)

    def versions(self) -> list[int]:
        """Complete snapshots (a failed write leaves a directory without ``_SUCCESS``)."""
        return self._listed(True)

    def _dir(self, v: int) -> str:
        return f"{self.root}/v={v:08d}"

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        vs = self.versions()
        if not vs:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        return self.spark.read.format(self.fmt).load(self._dir(vs[-1]))

    def path(self) -> str:
        """Directory of the newest snapshot."""
        vs = self.versions()
        if not vs:
            raise FileNotFoundError(f"no snapshot under {self.root}")
        return self._dir(vs[-1])

    def partition_columns(self) -> list[str]:
        """Partition columns of the newest snapshot, from its directory names."""
        fs, jvm = self._fs()
        out, at = [], jvm.org.apache.hadoop.fs.Path(self.path())
        while True:
            below = [st.getPath() for st in fs.listStatus(at) if st.isDirectory() and "=" in st.getPath().getName()]
            if not below:
                return out
            out.append(below[0].getName().split("=", 1)[0])
            at = below[0]

    def _retire(self) -> None:
        fs, jvm = self._fs()
        for v in self.versions()[:-self.keep]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(self._dir(v)), True)

    def _rewrite(self, change: Callable[[DataFrame], DataFrame], touched: DataFrame, parts: list[str]) -> DataFrame:
        """Rewrite only the partitions named in ``touched``: ``change`` maps their rows to
        the new rows (which may fall into other named partitions). The new rows are
        staged first, so no file is read while it is replaced."""
        fs, jvm = self._fs()
        cur, path = self.read(), self.path()
        t = touched.select(*[F.col(p).cast(cur.schema[p].dataType).alias(f"_p_{p}") for p in parts]).distinct()
        # worked out once, a row per touched partition, for the two passes below
        touched_at = f"{self.root}/_touched-{uuid.uuid4().hex}"
        t.write.format(self.fmt).save(touched_at)
        t = self.spark.read.schema(t.schema).format(self.fmt).load(touched_at)
        mine = cur.join(t, reduce(and_, [F.col(p).eqNullSafe(F.col(f"_p_{p}")) for p in parts]), "left_semi")
        # one row per touched partition and directory: metadata
        dirs = mine.select(*parts, F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_dir")).distinct().collect()
        staged_at = f"{self.root}/_staged-{uuid.uuid4().hex}"
        change(mine).select(*[F.col(f"`{c}`") for c in cur.columns]).write.format(self.fmt).save(staged_at)
        staged = self.spark.read.schema(cur.schema).format(self.fmt).load(staged_at)
        filled = {tuple(r) for r in staged.select(*parts).distinct().collect()}
        (staged.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).save(path))
        for r in dirs:
            if tuple(r)[:-1] not in filled:  # every row of it is gone
                fs.delete(jvm.org.apache.hadoop.fs.Path(r["_dir"]), True)
        for at in (staged_at, touched_at):
            fs.delete(jvm.org.apache.hadoop.fs.Path(at), True)
        self.spark.catalog.refreshByPath(path)
        return self.read()

    def commit(self, df: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
        """Write ``df`` as the next snapshot (it may read the current one) and return it."""
        every = self._listed(False)   # numbering skips failed attempts too
        target = self._dir((every[-1] + 1) if every else 1)
        w = df.write.format(self.fmt).mode("errorifexists")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.save(target)
        self._retire()
        return self.spark.read.format(self.fmt).load(target)

    def insert(self, df: DataFrame) -> DataFrame:
        """Append rows (``INSERT INTO``): new files in the current snapshot."""
        vs = self.versions()
        if not vs:
            return self.commit(df)
        cur = self.read()
        w = df.select(*[F.col(c).cast(cur.schema[c].dataType) for c in cur.columns]).write.format(self.fmt).mode("append")
        parts = self.partition_columns()
        (w.partitionBy(*parts) if parts else w).save(self._dir(vs[-1]))
        return self.read()

    def update(self, assignments: dict, cond: Column) -> DataFrame:
        cur, parts = self.read(), self.partition_columns()
        if not parts:
            return self.commit(update_where(cur, assignments, cond))
        hit = cur.where(cond)
        touched = hit.select(*parts)
        if set(parts) & set(assignments):  # rows move to other partitions, whose rows must stay
            touched = touched.union(update_where(hit, assignments, F.lit(True)).select(*parts))
        return self._rewrite(lambda df: update_where(df, assignments, cond), touched, parts)

    def delete(self, cond: Column) -> DataFrame:
        cur, parts = self.read(), self.partition_columns()
        if not parts:
            return self.commit(delete_where(cur, cond))
        return self._rewrite(lambda df: delete_where(df, cond), cur.where(cond).select(*parts), parts)

    def merge(self, source: DataFrame, keys: Sequence[str], order_cols: Sequence[str] = ()) -> DataFrame:
        if not self.exists():
            return self.commit(merge_upsert(None, source, keys, order_cols))
        cur, parts = self.read(), self.partition_columns()
        if not parts or set(source.columns) - set(cur.columns):  # new columns: every file gets them
            return self.commit(merge_upsert(cur, source, keys, order_cols), parts)
        new = source.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
        touched = cur.join(new, same, "left_semi").select(*parts).union(
            source.select(*[F.col(p).cast(cur.schema[p].dataType) for p in parts]))
        return self._rewrite(lambda df: merge_upsert(df, source, keys, order_cols), touched, parts)

    def evolve(self, add=(), rename=None) -> DataFrame:
        return self.commit(evolve_schema(self.read(), add, rename), self.partition_columns())


# ------------------------------------------------------------ catalog DDL

def create_schemas(spark: SparkSession, names: Sequence[str], comments: dict[str, str] | None = None) -> None:
    for n in names:
        c = (comments or {}).get(n)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{n}`" + (f" COMMENT '{c}'" if c else ""))


def ddl_from_schema(table: str, schema, comment: str | None = None, fmt: str = "parquet",
                    partitioned_by: Sequence[str] = (), location: str | None = None,
                    properties: dict[str, str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for a StructType (idempotent): types, NOT NULL,
    column comments (the field's ``comment`` metadata), table comment and properties."""
    def column(f) -> str:
        note = f.metadata.get("comment")
        return (f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                + (f" COMMENT '{_text(note)}'" if note else ""))

    cols = ", ".join(column(f) for f in schema.fields)
    sql = f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING {fmt}"
    if partitioned_by:
        sql += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if location:
        sql += f" LOCATION '{location}'"
    if comment:
        sql += f" COMMENT '{_text(comment)}'"
    if properties:
        sql += f" TBLPROPERTIES ({_properties(properties)})"
    return sql


def _text(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"'{_text(k)}' = '{_text(v)}'" for k, v in values.items())


def set_properties(spark: SparkSession, table: str, values: dict[str, str]) -> None:
    """``ALTER TABLE ... SET TBLPROPERTIES``."""
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_properties(values)})")


# Table property with the contract's NOT NULL columns: file tables read every column as
# nullable, whatever their DDL says, so the catalog keeps the contract here.
REQUIRED = "not_null_columns"


def create_tables(spark: SparkSession, layer: str, schemas: dict, fmt: str = "parquet") -> list[str]:
    """The tables of a layer by DDL, idempotent: comments on layer, table and NOT NULL columns."""
    create_schemas(spark, [layer], {layer: "tables of one layer"})
    out = []
    for name, schema in schemas.items():
        fields = [f if f.nullable or "comment" in f.metadata else StructField(f.name, f.dataType, False, {"comment": "required"})
                  for f in schema.fields]
        required = {REQUIRED: ",".join(f.name for f in fields if not f.nullable)}
        spark.sql(ddl_from_schema(f"`{layer}`.`{name}`", StructType(fields), f"{name} of a layer", fmt, properties=required))
        out.append(f"{layer}.{name}")
    return out


def ctas(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet",
         partition_by: Sequence[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """``CREATE TABLE ... AS SELECT``: managed, or external when ``path`` is given."""
    w = df.write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return df.sparkSession.table(table)


def register_external(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Register files already at ``path`` as an external table (dropping it keeps the files)."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{_text(path)}'")
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def publish(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """Make the files at ``path`` the external table ``database.name`` (pointing an
    existing one at them) and read it by name."""
    create_schemas(spark, [table.split(".")[0]])
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    return register_external(spark, table, path, fmt)


def catalog_inventory(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """(database, table, column, data_type, nullable, comment, table_type) of every table in
    ``databases``: metadata only, a handful of rows per table."""
    rows = []
    for db in databases:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            held = spark.sql(f"SHOW TBLPROPERTIES `{db}`.`{t.name}`").where(F.col("key") == REQUIRED).first()
            required = set(held["value"].split(",")) if held else set()
            for c in spark.catalog.listColumns(f"{db}.{t.name}"):
                rows.append((db, t.name, c.name, c.dataType, c.nullable and c.name not in required, c.description, t.tableType))
    return spark.createDataFrame(rows, "database string, table string, column string, data_type string, "
                                       "nullable boolean, comment string, table_type string")


def schema_listing(spark: SparkSession, pattern: str = "*") -> DataFrame:
    """(database, comment) of the databases whose name matches ``pattern``."""
    rows = [(d.name, d.description) for d in spark.catalog.listDatabases(pattern)]
    return spark.createDataFrame(rows, "database string, comment string")


def table_details(spark: SparkSession, table: str) -> DataFrame:
    """(name, value) lines of ``DESCRIBE TABLE EXTENDED``: location, provider, properties."""
    return (spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
            .select(F.col("col_name").alias("name"), F.col("data_type").alias("value")).where("name <> ''"))
