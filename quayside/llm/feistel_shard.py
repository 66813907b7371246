"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows are numbered 0 to N-1 in the order of their ids (global ranks over range
buckets: no single-task window). A keyed permutation of 0..N-1 maps the
row number to a position; ``shard = position mod shards`` and
``slot = position div shards``. Counts of shards differ by at most one, slots have no
gaps, the shuffle is the same in every run and layout, and both directions are
computable from (N, seed) alone: ``position_of`` and ``row_at``.

The permutation is an alternating Feistel network over Z_a x Z_b with
``a * b >= N`` as close as whole numbers near the square root allow, so fewer than one
value in sqrt(N) lies outside 0..N-1. Such values are permuted again until they
come back inside (cycle walking), which keeps the map a bijection of 0..N-1.

Only DataFrame functions: the first pass is a chain of projections that Spark
compiles; only the few values outside take the higher-order walk.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.operators.ranks import SortKey, global_ranks

PRIME = 2 ** 31 - 1
ROUNDS = 8


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0..n-1."""
    n: int
    seed: int = 1

    @property
    def sides(self) -> tuple[int, int]:
        a = max(1, math.isqrt(max(self.n - 1, 0)) + 1)
        return a, max(1, -(-self.n // a))

    @property
    def keys(self) -> list[tuple[int, int]]:
        """Multiplier and offset of every round (Lehmer generator of the seed)."""
        x, out = self.seed % PRIME or 1, []
        for _ in range(ROUNDS):
            pair = []
            for _ in range(2):
                x = x * 48271 % PRIME
                pair.append(x)
            out.append((pair[0], pair[1]))
        return out

    @property
    def walk(self) -> int:
        """Passes that bring every value back: at most one more than the values outside
        where those are few; beyond, 64 passes each missing with less than 1 in sqrt(n)."""
        a, b = self.sides
        return min(a * b - self.n + 1, 64)

    # the same steps on whole numbers, for tests and for look-ups outside Spark
    def position(self, row: int) -> int:
        a, b = self.sides
        x = row
        while True:
            lo, hi = x % b, x // b
            for i, (m, c) in enumerate(self.keys):
                if i % 2 == 0:
                    hi = (hi + _mix(lo, m, c)) % a
                else:
                    lo = (lo + _mix(hi, m, c)) % b
            x = hi * b + lo
            if x < self.n:
                return x


def _mix(v, m, c):
    """Round function on numbers or columns; products stay below 2**62."""
    w = (v + c) % PRIME
    return (w * w % PRIME * m + c) % PRIME


def _pass(df: DataFrame, perm: Permutation, source: str, target: str) -> DataFrame:
    """One application of the network as a chain of projections."""
    a, b = perm.sides
    df = df.withColumns({"_lo": F.col(source) % b, "_hi": F.expr(f"{U.quote(source)} div {b}")})
    for i, (m, c) in enumerate(perm.keys):
        if i % 2 == 0:
            df = df.withColumn("_hi", (F.col("_hi") + _mix(F.col("_lo"), m, c)) % a)
        else:
            df = df.withColumn("_lo", (F.col("_lo") + _mix(F.col("_hi"), m, c)) % b)
    return df.withColumn(target, F.col("_hi") * b + F.col("_lo")).drop("_lo", "_hi")


def _apply(x: Column, perm: Permutation, inverse: bool = False) -> Column:
    """The network as one expression, for the walk and for look-ups."""
    a, b = perm.sides
    rounds = [(i, m, c) for i, (m, c) in enumerate(perm.keys)]
    if inverse:
        rounds.reverse()
    table = F.array(*[F.struct(F.lit(i % 2 == 0).alias("left"), F.lit(m).cast("long").alias("m"), F.lit(c).cast("long").alias("c"))
                      for i, m, c in rounds])

    def step(acc: Column, k: Column) -> Column:
        hi, lo = acc["hi"], acc["lo"]
        if inverse:
            new_hi = (hi + (F.lit(a) - _mix(lo, k["m"], k["c"]) % a)) % a
            new_lo = (lo + (F.lit(b) - _mix(hi, k["m"], k["c"]) % b)) % b
        else:
            new_hi = (hi + _mix(lo, k["m"], k["c"])) % a
            new_lo = (lo + _mix(hi, k["m"], k["c"])) % b
        return F.struct(F.when(k["left"], new_hi).otherwise(hi).alias("hi"),
                        F.when(k["left"], lo).otherwise(new_lo).alias("lo"))

    # an exact division of numbers below 2**53
    start = F.struct(((x - x % b) / b).cast("long").alias("hi"), (x % b).alias("lo"))
    return F.aggregate(table, start, step, lambda acc: acc["hi"] * b + acc["lo"])


def _walk(x: Column, perm: Permutation, inverse: bool = False) -> Column:
    """Permute again while the value lies outside 0..n-1."""
    steps = F.sequence(F.lit(1), F.lit(perm.walk))
    return F.aggregate(steps, x, lambda acc, _: F.when(acc < perm.n, acc).otherwise(_apply(acc, perm, inverse)))


def position_of(row: Column, perm: Permutation) -> Column:
    """Position of a row number."""
    return _walk(_apply(row.cast("long"), perm), perm)


def row_at(position: Column, perm: Permutation) -> Column:
    """Row number at a position (the inverse)."""
    return _walk(_apply(position.cast("long"), perm, inverse=True), perm, inverse=True)


def feistel_shards(spark: SparkSession, docs: DataFrame, shards: int = 16, seed: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, row_number, position, shard, slot``.

    Row numbers follow the id (null ids first), then the text's CRC, size and a
    hash of the text; fully equal rows are interchangeable. A null text has size 1
    and CRC 0. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    s = U.Scratch(spark, "feistel")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = s.save(docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                              F.crc32(text.cast("binary")).cast("long").alias("text_crc32"), F.xxhash64(text).alias("_h")), "rows")
    perm = Permutation(rows.count(), seed)
    ranked = global_ranks(rows, [SortKey.asc("doc_id")], ["text_crc32", "size", "_h"], {"_rn": ("row_number",)})
    out = _pass(ranked.withColumn("row_number", F.col("_rn") - 1), perm, "row_number", "_x")
    out = out.withColumn("position", F.when(F.col("_x") < perm.n, F.col("_x")).otherwise(_walk(F.col("_x"), perm)))
    return out.select("doc_id", "size", "text_crc32", "row_number", "position",
                      (F.col("position") % shards).cast("int").alias("shard"),
                      F.expr(f"position div {shards}").alias("slot"))
