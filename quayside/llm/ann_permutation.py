"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. Largest inner product is
turned into least distance by one more coordinate, ``sqrt(M**2 - |x|**2)`` with
the largest norm M (zero for queries), so both use the same pivots.

* Equal vectors are one entry: its smallest ids stand for it, so a vector that
  makes up a third of the table costs one row.
* Rows are dealt evenly into blocks by a hash. Each block posts its rows in
  pivot inverted files: for every pivot the rows that have it among their
  ``prefix`` nearest, with its place.
* A query reads the files of its own nearest pivots and sums, per row, how far
  both orders agree: the footrule distance of the two prefixes is a constant
  minus ``2 * sum over shared pivots of (prefix - larger place)``. The best ``share``
  of each block by footrule is reranked by the exact inner product in double
  precision, and the blocks' best are merged.

The query set meets all rows in a grid of blocks of bounded size. Pivots come
from a bounded sample (``pivots`` rows with the smallest id hashes); every row is
indexed. Recall against brute force is measured in the tests (``recall``).

Defined results: vectors that are null, empty, zero or hold a null or non-finite
component and rows with a null id take no part; vectors meet those of their own
dimension, which have an index to themselves (an inner product needs equal dimensions);
of repeated ids one row counts; with at most ``k`` candidates all are returned; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm import util as U

PIVOTS, PREFIX = 256, 64
#: Part of each block that is reranked.
SHARE = 0.15
#: Most rows and queries of a cell of the grid, and least number of row blocks.
BLOCK_ROWS, BLOCK_QUERIES, LEAST_BLOCKS = 16_384, 2_048, 16


def _valid(batches):
    """Arrow task: (id, vector) to the usable rows as (id, sig, dim, norm2, vec)."""
    for b in batches:
        ids, sigs, dims, norms, vecs = [], [], [], [], []
        for i, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
            n = float(x @ x)
            if not np.isfinite(x).all() or not x.any():
                continue
            raw = x.tobytes()
            ids.append(i)
            sigs.append(hashlib.blake2b(raw, digest_size=16).digest())
            dims.append(len(x))
            norms.append(n)
            vecs.append(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sigs, pa.binary()), pa.array(dims, pa.int32()),
             pa.array(norms, pa.float64()), pa.array(vecs, pa.binary())], names=["id", "sig", "dim", "norm2", "vec"])


def nearest_pivots(x: np.ndarray, extra: np.ndarray, pivots: np.ndarray, pivot_extra: np.ndarray, prefix: int) -> np.ndarray:
    """Each row's nearest pivots in order (ties: smaller pivot number)."""
    near = x @ pivots.T + extra[:, None] * pivot_extra[None, :]
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix].astype(np.int16)


class PivotFiles:
    """Inverted files of one block: per pivot the rows that list it, with its place."""

    def __init__(self, orders: np.ndarray, pivots: int):
        self.rows, self.prefix = orders.shape
        flat = orders.ravel()
        order = np.argsort(flat, kind="stable")
        self.row, self.place = order // self.prefix, order % self.prefix
        self.starts = np.searchsorted(flat[order], np.arange(pivots + 1))

    def agreement(self, order: np.ndarray) -> np.ndarray:
        """Of every row: half the footrule constant minus half its footrule distance."""
        rows, gains = [], []
        for j, p in enumerate(order):
            a, b = self.starts[p], self.starts[p + 1]
            rows.append(self.row[a:b])
            gains.append(self.prefix - np.maximum(self.place[a:b], j))
        return np.bincount(np.concatenate(rows), np.concatenate(gains), minlength=self.rows)


def _matrix(blobs, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dim)


def _search(dim: int, pivots: int, prefix: int, share: float, k: int):
    """Cell task: a block of rows and a block of queries to (query, uid, score)."""
    def run(key, rows: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query": pd.Series(dtype="int64"), "uid": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        rows = rows.sort_values("uid")
        uid, x = rows["uid"].to_numpy(), _matrix(rows["vec"], dim)
        files = PivotFiles(np.frombuffer(b"".join(rows["line"]), np.int16).reshape(len(rows), -1), pivots)
        take = min(len(rows), max(int(np.ceil(share * len(rows))), 2 * k + 1))
        out = []
        lines = np.frombuffer(b"".join(asks["qline"]), np.int16).reshape(len(asks), -1)
        for q, v, line in zip(asks["quid"].to_numpy(), _matrix(asks["qvec"], dim), lines, strict=True):
            gain = files.agreement(line)
            best = np.argpartition(-gain, take - 1)[:take] if take < len(gain) else np.arange(len(gain))
            score = (x[best] * v).sum(axis=1)
            if len(best) > k + 1:  # one more than k, as the query itself may be among them; ties stay
                least = np.partition(score, -(k + 1))[-(k + 1)]
                best, score = best[score >= least], score[score >= least]
            out.append(pd.DataFrame({"query": q, "uid": uid[best], "score": score}))
        return pd.concat(out)
    return run


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = PIVOTS,
            prefix: int = PREFIX, share: float = SHARE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is divisible by
    ``every``, the ``k`` nearest other rows found, nearest first (ties: smaller id)."""
    s = U.Scratch(spark, "ann")
    src = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    base = s.save(src.mapInArrow(_valid, "id bigint, sig binary, dim int, norm2 double, vec binary"), "base")
    # of repeated ids, the row with the smallest signature counts
    ids = s.save(base.groupBy("id").agg(F.min("sig").alias("sig")), "ids")
    entries = s.save(ids.groupBy("sig").agg(F.min("id").alias("uid")), "entries")
    # the ids that stand for an entry: no more than k + 1 of it can be among a query's k nearest
    place = F.row_number().over(W.partitionBy("sig").orderBy("id"))
    members = ids.withColumn("n", place).where(F.col("n") <= k + 1).join(entries, "sig").select("uid", F.col("id").alias("vec_id"))
    members = s.save(members, "members")

    unique = (base.join(entries.select("sig", F.col("uid").alias("id"), "uid"), ["sig", "id"]).select("uid", "dim", "norm2", "vec")
              .withColumn("n", F.row_number().over(W.partitionBy("uid").orderBy("norm2"))).where("n = 1").drop("n"))
    unique = s.save(unique, "unique")
    asked = ids.where(F.col("id") % every == 0).join(entries, "sig").select("uid", F.col("id").alias("query_id"))
    asked = s.save(asked, "asked")
    found = spark.createDataFrame([], "query bigint, uid bigint, score double")
    # one row per dimension
    for dim, total, top in unique.groupBy("dim").agg(F.count(F.lit(1)), F.max("norm2")).orderBy("dim").collect():
        own = unique.where(F.col("dim") == dim).drop("dim")
        found = found.unionByName(_search_all(s, own, asked, dim, total, top, k, pivots, prefix, share))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(found.withColumnRenamed("uid", "near"), F.col("uid") == F.col("query")).drop("uid", "query")
            .join(members.withColumnRenamed("uid", "near"), "near").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search_all(s: U.Scratch, unique: DataFrame, asked: DataFrame, dim: int, total: int, top: float, k: int,
                pivots: int, prefix: int, share: float) -> DataFrame:
    """``query, uid, score``: the best entries found for the asked ones among the ``total``
    vectors of one dimension, whose largest squared norm is ``top``."""
    picked = unique.orderBy(F.xxhash64("uid"), "uid").limit(pivots).toPandas().sort_values("uid")
    p = _matrix(picked["vec"], dim)
    p_extra = np.sqrt(np.maximum(top - picked["norm2"].to_numpy(), 0))
    prefix = min(prefix, len(p))
    blocks = max(LEAST_BLOCKS, -(-total // BLOCK_ROWS))

    def index(batches):
        for b in batches:
            x = _matrix(b.column(2).to_pylist(), dim)
            n2 = b.column(1).to_numpy(zero_copy_only=False)
            as_row = nearest_pivots(x, np.sqrt(np.maximum(top - n2, 0)), p, p_extra, prefix)
            as_query = nearest_pivots(x, np.zeros(len(x)), p, p_extra, prefix)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *[pa.array([r.tobytes() for r in o], pa.binary()) for o in (as_row, as_query)]],
                names=["uid", "vec", "row_line", "query_line"])

    idx = s.save(unique.mapInArrow(index, "uid bigint, vec binary, row_line binary, query_line binary"), f"index{dim}")
    asks = (idx.join(asked.select("uid").distinct(), "uid", "left_semi")
            .select(F.col("uid").alias("quid"), F.col("vec").alias("qvec"), F.col("query_line").alias("qline")))
    slices = max(1, -(-asks.count() // BLOCK_QUERIES))

    def deal(col: str, n: int):
        return F.pmod(F.xxhash64(col, F.lit(n)), F.lit(n)).cast("int")

    def every_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = idx.select("uid", "vec", F.col("row_line").alias("line"), deal("uid", blocks).alias("b"), every_of(slices).alias("q"))
    right = asks.select("*", deal("quid", slices).alias("q"), every_of(blocks).alias("b"))
    found = (left.groupBy("b", "q").cogroup(right.groupBy("b", "q"))
             .applyInPandas(_search(dim, len(p), prefix, share, k), "query bigint, uid bigint, score double"))
    # k + 1 entries of each query suffice: its own entry may hold the query alone
    return s.save(found.withColumn("n", F.rank().over(W.partitionBy("query").orderBy(F.desc("score"))))
                  .where(F.col("n") <= k + 1).drop("n"), f"found{dim}")


def recall(found: DataFrame, vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id",
           vec_col: str = "embedding") -> float:
    """Share of the exact k nearest that ``found`` holds (brute force; small inputs)."""
    pdf = vectors.select(id_col, vec_col).where(F.col(vec_col).isNotNull()).toPandas().sort_values(id_col)
    x, ids = np.stack(pdf[vec_col].to_numpy()).astype(np.float64), pdf[id_col].to_numpy()
    got = found.toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = want = 0
    for i in np.flatnonzero(ids % every == 0):
        score = x @ x[i]
        score[i] = -np.inf
        best = ids[np.lexsort((ids, -score))][:min(k, len(ids) - 1)]
        hits += len(set(best) & got.get(ids[i], set()))
        want += len(best)
    return hits / max(want, 1)
