"""Referential-integrity filters and quarantine frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ri_filter(df: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Keep rows whose foreign keys all exist in their parent frames.

    ``parents`` is a list of ``(parent_df, key)``. A left-semi join never
    duplicates rows, even if a parent key repeats, and only the key column of
    the parent is read. Broadcast or shuffle is left to AQE (size-checked at
    run time); a hot key on the child side is split by AQE skew handling.
    """
    for parent, key in parents:
        df = df.join(parent.select(key), key, "left_semi")
    return df


def ri_split(df: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Every input row once; ``_reject_reason`` names the first missing parent, NULL when valid.

    Parent keys are reduced to distinct values first (a partial aggregate), so
    the left join cannot multiply child rows.
    """
    reason = F.lit(None).cast("string")
    marks = []
    for i, (parent, key) in enumerate(parents):
        mark = f"_ri_ok_{i}"
        keys = parent.select(key).where(F.col(key).isNotNull()).distinct().withColumn(mark, F.lit(True))
        df = df.join(keys, key, "left")
        marks.append((mark, key))
    for mark, key in reversed(marks):
        reason = F.when(F.col(mark).isNull(), F.lit(f"unknown_{key}")).otherwise(reason)
    return df.withColumn("_reject_reason", reason).drop(*[m for m, _ in marks])
