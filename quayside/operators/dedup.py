"""Latest-row-per-key deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def tie_break_columns(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> list[str]:
    """Every remaining orderable column, in schema order."""
    skip = set(keys) | set(order_cols)
    return [f.name for f in df.schema.fields
            if f.name not in skip and not isinstance(f.dataType, _UNORDERABLE)]


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_cols: Sequence[str] = ("_bronze_loaded_at",),
    tie_break: Sequence[str] | None = None,
    optional: Sequence[str] = (),
) -> DataFrame:
    """Keep one row per key: the newest by ``order_cols`` (descending, NULLs last).

    An order column that the frame lacks raises, unless it is named in ``optional``.
    Ties are broken by ``tie_break`` (default: all other orderable columns, also
    descending), so the kept row does not depend on partitioning or retries.
    ``row_number() = 1`` lets Spark insert a partial ``WindowGroupLimit`` before
    the shuffle, so a key with very many copies is cut down map-side instead of
    being sorted whole in one task.
    """
    missing = [c for c in order_cols if c not in df.columns and c not in optional]
    if missing:
        raise ValueError(f"order columns {missing} are not in the frame")
    order_cols = [c for c in order_cols if c in df.columns]
    if tie_break is None:
        tie_break = tie_break_columns(df, keys, order_cols)
    order = [F.col(c).desc_nulls_last() for c in [*order_cols, *tie_break]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str],
                  tie_break: Sequence[str] | None = None) -> DataFrame:
    """Keep the *oldest* row per key by ``order_cols`` (ascending, NULLs last);
    ties broken by the other columns, ascending."""
    if tie_break is None:
        tie_break = tie_break_columns(df, keys, order_cols)
    order = [F.col(c).asc_nulls_last() for c in [*order_cols, *tie_break]]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
