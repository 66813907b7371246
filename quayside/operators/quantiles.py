"""Quantiles that roll up: KLL sketches.

A sketch of ``k`` holds some ``3 k`` numbers whatever it has seen, and sketches merge, so
months are merged from days and totals from months without reading the rows again. The
answer is a value whose rank is off by a share of the rows: with ``K`` the error stays far
below ``RANK_ERROR`` (the bound that a sketch of 200 keeps); up to ``K`` rows it is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 800
RANK_ERROR = 0.0133


def sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = K) -> DataFrame:
    """``keys, n, sketch`` of the non-NULL values."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"))


def merge_sketches(df: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Sketches of a coarser level."""
    return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def quantile(sketch: str | Column = "sketch", at: float = 0.5) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch) if isinstance(sketch, str) else sketch, F.lit(float(at)))


def rank_check(df: DataFrame, answers: DataFrame, keys: Sequence[str], value: str, answer: str, at: float = 0.5,
               error: float = RANK_ERROR) -> DataFrame:
    """``keys, n, within_bound``: whether the exact rank of each group's answer lies within
    ``error`` of the rows around ``at`` (one aggregate over ``df``)."""
    marks = {k: f"_k{i}" for i, k in enumerate(keys)}
    given = answers.select(*[F.col(k).alias(v) for k, v in marks.items()], F.col(answer).alias("_answer"))
    same = F.lit(True)
    for k, v in marks.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    v = F.col(value).cast("double")
    seen = df.where(F.col(value).isNotNull())
    joined = seen.join(given, same) if keys else seen.withColumn("_answer", given.scalar())
    out = joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count_if(v < F.col("_answer")).alias("_below"),
                                    F.count_if(v <= F.col("_answer")).alias("_upto"))
    within = (F.col("_below") <= F.col("n") * (at + error)) & (F.col("_upto") >= F.col("n") * (at - error))
    return out.select(*keys, "n", within.alias("within_bound"))
