"""Connected components by alternating large-star and small-star steps.

Every step is a partial aggregation (the smallest neighbour of a node) and a join
back on the node, so a node with very many links is never gathered in one task.
The edge list is written to the shared folder after each round, in files by its number
of rows: a small list over very many shuffle partitions would be as many small files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.util import Scratch


def _star(pairs: DataFrame, small: bool) -> DataFrame:
    """``pairs`` (u, v); small: link u and its smaller neighbours to the least of
    them; large: link u's larger neighbours to the least of u and its neighbours."""
    if small:
        p = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    else:
        p = pairs.union(pairs.select("v", "u"))
    low = p.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    j = p.join(low, "u")
    if small:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    else:
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _is_done(pairs: DataFrame) -> bool:
    """Stars only: every node has one parent, and no parent has one."""
    ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        pairs.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc", rows: int | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns u, v, one orderable
    type, no nulls); the component is its smallest node. No edges: no rows. ``rows``:
    about as many edges, if known (see ``Scratch.save``)."""
    pairs = scratch.save(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                         .distinct(), f"{name}-0", rows=rows)
    i = 0
    while not _is_done(pairs):
        i += 1
        pairs = scratch.save(_star(_star(pairs, small=False), small=True), f"{name}-{i}", rows=pairs.count())
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select("component", "component").distinct())


def merged(labels: DataFrame, edges: DataFrame, scratch: Scratch, name: str, rows: int | None = None) -> DataFrame:
    """The components of a graph with ``labels`` (node, component) once ``edges`` are added
    to it. Only the components that the new edges join are searched."""
    def root(end: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.col("component").alias(f"{end}_root"))

    ends = (edges.join(root("u"), "u", "left").join(root("v"), "v", "left")
            .select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v")))
    joined = components(ends, scratch, name, rows)
    new = joined.join(labels, "node", "left_anti")
    to = joined.select(F.col("node").alias("component"), F.col("component").alias("least"))
    return (labels.join(to, "component", "left").select("node", F.coalesce("least", "component").alias("component"))
            .union(new.select("node", "component")))
