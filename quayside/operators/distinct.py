"""Exact distinct counts that roll up: bitmaps over dense ids.

A distinct count can't be added up, a set can. Ids are numbered densely once (from
their dimension table, not from the fact), every group keeps the set of its ids as
bitmaps of 32,768 numbers each, and a coarser level is the OR of its finer ones.
One pass over the rows serves all columns and the finest level; months and totals
read the bitmaps only.

A bitmap takes 4 KB whatever it holds, so a finest level whose groups hold fewer than
some 500 ids of a block of 32,768 is cheaper counted directly; number ids so that those that
occur together are close (``order``: say by first use) or start at a coarser level.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.ranks import SortKey, global_ranks


def dense_ids(df: DataFrame, column: str, order: SortKey | None = None) -> DataFrame:
    """(``column``, ``n``): every distinct non-NULL value numbered from 1, without a one-task
    window. ``order`` numbers by another column (its least value per id)."""
    seen = df.where(F.col(column).isNotNull())
    if order is None:
        values, keys = seen.select(column).distinct(), [SortKey.asc(column)]
    else:
        values, keys = seen.groupBy(column).agg(F.min(order.column).alias(order.column)), [order]
    return global_ranks(values, keys, [column], {"n": ("row_number",)}).select(column, "n")


def id_bitmaps(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str], ids: Mapping[str, DataFrame]) -> DataFrame:
    """``keys, _kind, _block, _bits``: for every group the sets of the dense ids of ``columns``
    (output name -> column); ``ids``: column -> its dense ids. A group without ids
    keeps an empty set. One scan of ``df``."""
    marks = {}
    for i, (name, column) in enumerate(columns.items()):
        number = ids[column].select(F.col(column).alias(f"_v{i}"), F.col("n").alias(f"_n{i}"))
        df = df.join(number, F.col(column) == F.col(f"_v{i}"), "left")
        marks[name] = F.col(f"_n{i}")
    kinds = F.array(*[F.struct(F.lit(name).alias("_kind"), n.cast("long").alias("_n")) for name, n in marks.items()])
    each = df.select(*keys, F.explode(kinds).alias("_e")).select(*keys, "_e._kind", "_e._n")
    return each.groupBy(*keys, "_kind", F.bitmap_bucket_number("_n").alias("_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_n")).alias("_bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sets of a coarser level: ``keys`` is a subset of the finer level's."""
    return bitmaps.groupBy(*keys, "_kind", "_block").agg(F.bitmap_or_agg("_bits").alias("_bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """``keys`` and one exact distinct count per name."""
    bits = F.bitmap_count("_bits")
    return bitmaps.groupBy(*keys).agg(*[F.sum(F.when(F.col("_kind") == n, bits).otherwise(0)).alias(n) for n in names])


def distinct_rollup(df: DataFrame, levels: Sequence[Sequence[str]], columns: Mapping[str, str], ids: Mapping[str, DataFrame],
                    store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df) -> list[DataFrame]:
    """Exact distinct counts of ``columns`` at every level, finest first; each level's
    keys are a subset of the one before. ``store`` may write the bitmaps of a level, so
    that the next one starts from them."""
    out, sets = [], None
    for i, keys in enumerate(levels):
        made = id_bitmaps(df, keys, columns, ids) if sets is None else merge_bitmaps(sets, keys)
        sets = store(f"bitmaps_{i}", made)
        out.append(bitmap_counts(sets, keys, list(columns)))
    return out
