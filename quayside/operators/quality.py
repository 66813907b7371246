"""Data-quality metrics, status, gates and run-metrics rows.

All metrics are computed by aggregates (one pass each) and come back as small
DataFrames; nothing is counted on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside import contracts as K
from quayside.functions.columns import bucket


def dq_metrics(table: str, raw: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: input, output, duplicates removed, nulls filled, quarantined, pass rate.

    ``raw`` is the input before deduplication; ``checked`` is the deduplicated
    frame with ``_reject_reason`` and ``_nulls_filled`` (see ``with_rejects``).
    input = output + duplicates removed + quarantined holds by construction.
    """
    input_rows = raw.agg(F.count(F.lit(1))).scalar()
    m = checked.agg(
        F.count_if(F.col("_reject_reason").isNull()).alias("output_rows"),
        F.count_if(F.col("_reject_reason").isNotNull()).alias("quarantined"),
        F.coalesce(F.sum(F.when(F.col("_reject_reason").isNull(), F.col("_nulls_filled"))), F.lit(0))
        .cast("bigint").alias("nulls_filled"),
        F.count(F.lit(1)).alias("_deduped"),
    )
    m = m.withColumn("input_rows", input_rows)
    return m.select(
        F.lit(table).alias("table"),
        "input_rows",
        "output_rows",
        (F.col("input_rows") - F.col("_deduped")).alias("duplicates_removed"),
        "nulls_filled",
        "quarantined",
        F.round(F.col("output_rows") / F.greatest(F.col("input_rows"), F.lit(1)) * 100, 2).alias("pass_rate_pct"),
    )


def dq_status(metrics: DataFrame) -> DataFrame:
    """PASS at >= 95 %, WARN at >= 80 %, else FAIL."""
    return metrics.withColumn("status", bucket("pass_rate_pct", *K.DQ_STATUS))


def dq_gate(table: str, raw: DataFrame, checked: DataFrame, key_columns: Sequence[str],
            thresholds: dict | None = None) -> DataFrame:
    """Threshold gate in long form: (table, check, value, limit, passed).

    Checks: pass rate >= minimum, worst key-column null % of the valid rows <= maximum,
    duplicate % <= maximum, output rows >= minimum row count of the table. One
    aggregate over ``checked`` carries all of them; ``raw`` is only counted.
    """
    th = thresholds or K.THRESHOLDS
    valid = F.col("_reject_reason").isNull()
    m = checked.agg(F.count_if(valid).alias("rows"), F.count(F.lit(1)).alias("deduped"),
                    *[F.count_if(valid & F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(key_columns)])
    m = m.withColumn("seen", raw.agg(F.count(F.lit(1))).scalar())

    def share(num: Column, den: Column) -> Column:
        return F.round(num / F.greatest(den, F.lit(1)) * 100, 2)

    nulls = [share(F.col(f"_null_{i}"), F.col("rows")) for i in range(len(key_columns))]
    rows = F.col("rows")
    m = m.select(share(rows, F.col("seen")).alias("pass_rate_pct"),
                 (F.greatest(*nulls) if len(nulls) > 1 else nulls[0]).cast("double").alias("null_pct"),
                 share(F.col("seen") - F.col("deduped"), F.col("seen")).alias("dup_pct"), rows.cast("double").alias("rows"))
    checks = [
        ("min_pass_rate_pct", "pass_rate_pct", float(th["min_pass_rate_pct"]), ">="),
        ("max_null_pct", "null_pct", float(th["max_null_pct"]), "<="),
        ("max_duplicate_pct", "dup_pct", float(th["max_duplicate_pct"]), "<="),
        ("min_row_count", "rows", float(th["min_row_count"].get(table, 0)), ">="),
    ]
    stack = ", ".join(f"'{name}', `{col}`, CAST({limit} AS DOUBLE), '{op}'" for name, col, limit, op in checks)
    long = m.selectExpr(f"stack({len(checks)}, {stack}) AS (check, value, limit, op)")
    passed = F.when(F.col("op") == ">=", F.col("value") >= F.col("limit")).otherwise(F.col("value") <= F.col("limit"))
    return long.select(F.lit(table).alias("table"), "check", "value", "limit",
                       F.coalesce(passed, F.lit(False)).alias("passed"))


def assert_non_empty(df: DataFrame, name: str) -> None:
    """Raise if the frame has no row (a one-row probe, not a count)."""
    if df.isEmpty():
        raise ValueError(f"data quality check failed: {name} has 0 records")

