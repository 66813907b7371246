"""Exact deduplication against immutable snapshots with static binary-fuse filters.

Texts are equal when identical after replacing each run of separators by one
space. A *snapshot* is an immutable set of documents: its exact buckets hold one
row per distinct text (SHA-256 digest, smallest id, number of copies), and one
binary-fuse filter per bucket (8-bit fingerprints, about 1.13 bytes a text)
answers "surely new" or "maybe known".

A new batch is first grouped by digest among itself (partial aggregation, so a
text that makes up a third of the batch is one row per task). Its distinct
digests stream past the filter of their bucket; only positives join the exact
buckets, and of those only digest matches fetch both texts for a byte check.

Everything that moves between tasks is narrow (digest, id, count); texts move
only for the byte checks, one pair per distinct repeated text.

Defined results: a null text counts as empty; rows with a null id are counted in
their group and stay only if the whole group has no id; of repeated rows
(same id, equal text) one stays; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm import util as U

SEPARATORS = r"[\x20\x09-\x0D]+"
#: Texts per filter: bounds the memory of one filter (about 1.2 MB).
BUCKET_TEXTS = 1_000_000
MIN_BUCKETS = 64


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SEPARATORS, " ")


def digest(text):
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalised(text), 256))


# --- binary-fuse filter ------------------------------------------------------

@dataclass
class FuseFilter:
    """Static 3-wise binary-fuse filter with 8-bit fingerprints over 64-bit keys."""
    seed: int
    segment: int
    span: int
    cells: np.ndarray

    @staticmethod
    def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
        return U.mix(keys + U.U64(seed))

    @staticmethod
    def _slots(h: np.ndarray, segment: int, span: int) -> np.ndarray:
        low = U.U64(segment - 1)
        a = ((h >> U.U64(32)) * U.U64(span)) >> U.U64(32)
        b = (a + U.U64(segment)) ^ ((h >> U.U64(18)) & low)
        c = (a + U.U64(2 * segment)) ^ (h & low)
        return np.stack([a, b, c]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return (h ^ (h >> U.U64(32))).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        """A filter of distinct keys: slots are peeled in rounds (every slot that
        holds one key frees that key), then filled in reverse order."""
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << min(18, max(2, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
        factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
        segments = max(1, -(-int(round(n * factor)) // segment) - 2)
        span, size = segments * segment, (segments + 2) * segment
        for seed in range(1, 200):
            h = cls._hash(keys, seed * 0x9E3779B97F4A7C15 % (1 << 64))
            slots = cls._slots(h, segment, span)
            count = np.bincount(slots.ravel(), minlength=size)
            who = np.zeros(size, np.int64)
            index = np.arange(n)
            for s in slots:
                np.bitwise_xor.at(who, s, index)
            order, left = [], n
            single = np.flatnonzero(count == 1)
            while len(single):
                key, at = np.unique(who[single], return_index=True)
                free = single[at]
                order.append((key, free))
                left -= len(key)
                touched = slots[:, key]
                for s in touched:
                    np.subtract.at(count, s, 1)
                    np.bitwise_xor.at(who, s, key)
                touched = np.unique(touched)
                single = touched[count[touched] == 1]
            if left:
                continue
            cells = np.zeros(size, np.uint8)
            prints = cls._print(h)
            for key, free in reversed(order):
                a, b, c = slots[:, key]
                cells[free] = prints[key] ^ cells[a] ^ cells[b] ^ cells[c]
            return cls(seed, segment, span, cells)
        raise RuntimeError("no filter found")

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """False: surely not in the set. True: in the set, or 1 in 256 by chance."""
        h = self._hash(keys.astype(np.uint64), self.seed * 0x9E3779B97F4A7C15 % (1 << 64))
        a, b, c = self._slots(h, self.segment, self.span)
        return (self.cells[a] ^ self.cells[b] ^ self.cells[c]) == self._print(h)

    def to_bytes(self) -> bytes:
        return np.array([self.seed, self.segment, self.span], np.int64).tobytes() + self.cells.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> FuseFilter:
        head = np.frombuffer(raw, np.int64, 3)
        return cls(int(head[0]), int(head[1]), int(head[2]), np.frombuffer(raw, np.uint8, offset=24))


# --- snapshots -----------------------------------------------------------------

@dataclass
class Snapshot:
    """An immutable set of documents: texts by id, exact buckets and filters."""
    docs: DataFrame
    exact: DataFrame
    filters: DataFrame
    buckets: int


def _key(col: str = "digest"):
    """First eight bytes of the digest."""
    return F.expr(f"substring({col}, 1, 8)")


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def _keys(arr: pa.Array) -> np.ndarray:
    data, offs = U.text_buffers(arr)
    return np.frombuffer(data[offs[0]:offs[-1]].tobytes(), np.uint64)


def group_batch(keyed: DataFrame) -> DataFrame:
    """Duplicates inside one batch: a row per digest with its smallest id, one row that has
    it (any, without ids) and copies."""
    return keyed.groupBy("digest").agg(F.min("id").alias("keep"), F.coalesce(F.min_by("row", "id"), F.min("row")).alias("keep_row"),
                                       F.count(F.lit(1)).alias("copies"))


def _filters(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket to one filter per bucket; holds one bucket's keys."""
    now, held = None, []

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.int32()), pa.array([FuseFilter.build(np.concatenate(held)).to_bytes()], pa.binary())],
            names=["bucket", "cells"])

    for b in batches:
        buckets, keys = b.column(0).to_numpy(), _keys(b.column(1))
        for x in np.unique(buckets):
            if now is not None and x != now:
                yield done()
                held = []
            now = int(x)
            held.append(keys[buckets == x])
    if held:
        yield done()


def build_snapshot(docs: DataFrame, groups: DataFrame, scratch: U.Scratch, name: str) -> Snapshot:
    """``docs`` (id, text) and its ``group_batch`` rows to an immutable snapshot."""
    exact = scratch.save(groups, f"{name}-exact")
    buckets = max(MIN_BUCKETS, -(-exact.count() // BUCKET_TEXTS))
    filters = scratch.save(
        exact.select(_bucket(buckets).alias("bucket"), _key().alias("key"))
        .repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_filters, "bucket int, cells binary"), f"{name}-filters")
    return Snapshot(docs, exact, filters, buckets)


def _screen(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, its filter first: the digests that the filter may hold."""
    now, filt = None, None
    for b in batches:
        buckets = b.column(0).to_numpy()
        cells = b.column(1)
        known = np.asarray(cells.is_valid())
        keep = np.zeros(b.num_rows, bool)
        for x in np.unique(buckets):
            rows = buckets == x
            if x != now:
                now, filt = x, None
            own = np.flatnonzero(rows & known)
            if len(own):
                filt = FuseFilter.from_bytes(cells[int(own[0])].as_py())
            ask = np.flatnonzero(rows & ~known)
            if filt is not None and len(ask):
                keep[ask] = filt.holds(_keys(b.column(2).take(pa.array(ask))))
        yield pa.RecordBatch.from_arrays([b.column(3)], names=["digest"]).filter(pa.array(keep))


def screen(groups: DataFrame, snap: Snapshot) -> DataFrame:
    """Digests of a batch that the snapshot may hold (no false negatives)."""
    none = F.lit(None)
    ask = groups.select(_bucket(snap.buckets).alias("bucket"), none.cast("binary").alias("cells"),
                        _key().alias("key"), "digest")
    own = snap.filters.select("bucket", "cells", none.cast("binary").alias("key"), none.cast("binary").alias("digest"))
    return (own.unionByName(ask).repartition("bucket").sortWithinPartitions("bucket", F.col("cells").isNull())
            .mapInArrow(_screen, "digest binary"))


def _texts(docs: DataFrame, ids: DataFrame, out: str) -> DataFrame:
    """Normalised texts of the wanted ids, as (digest, ``out``): one per digest."""
    only = U.id_filter(ids, "id")

    def run(batches):
        for b in batches:
            ids_ = b.column(0)
            hit = U.might_hold(only, ids_.fill_null(0).to_numpy(zero_copy_only=False)) & np.asarray(ids_.is_valid())
            yield b.filter(pa.array(hit))

    thin = docs.mapInArrow(run, "id bigint, text string")
    return (thin.withColumn("digest", digest(F.col("text"))).join(ids, ["id", "digest"])
            .select("digest", normalised(F.col("text")).alias(out)).dropDuplicates(["digest"]))


def match_batch(docs: DataFrame, groups: DataFrame, snap: Snapshot, scratch: U.Scratch, name: str) -> DataFrame:
    """(digest) of the batch's texts that the snapshot holds, byte for byte."""
    maybe = screen(groups, snap)
    old = snap.exact.select("digest", F.col("keep").alias("old"))
    pairs = scratch.save(groups.join(maybe, "digest", "left_semi").join(old, "digest")
                         .select("digest", "keep", "old"), f"{name}-pairs")
    new_text = _texts(docs, pairs.select(F.col("keep").alias("id"), "digest"), "new_text")
    old_text = _texts(snap.docs, pairs.select(F.col("old").alias("id"), "digest"), "old_text")
    # without an id there is no text to fetch; the full digest decides there
    return (pairs.join(new_text, "digest", "left").join(old_text, "digest", "left")
            .where("new_text is null or old_text is null or new_text = old_text").select("digest"))


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                batches: int = 2) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The table is taken as ``batches`` batches (by a hash of the id). Each is grouped
    among itself, screened against the snapshots of the earlier ones, and then
    becomes a snapshot itself.
    """
    s = U.Scratch(spark, "exact-dedup")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    part = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    # the row number tells repeated rows apart; it holds once the table is written
    keyed = s.save(src.select("id", part.alias("part"), digest(F.col("text")).alias("digest"),
                              F.monotonically_increasing_id().alias("row")), "keyed")
    total, snaps = None, []
    for i in range(batches):
        batch = src.where(part == i)
        groups = s.save(group_batch(keyed.where(F.col("part") == i)), f"batch-{i}")
        rows = groups.withColumn("part", F.lit(i))
        known = None
        for j, snap in enumerate(snaps):
            hit = match_batch(batch, groups, snap, s, f"batch-{i}-{j}").select("digest")
            known = hit if known is None else known.union(hit)
        if known is None:
            known = groups.select("digest").limit(0)
        rows = rows.join(known.distinct().withColumn("same", F.lit(True)), "digest", "left")
        total = rows if total is None else total.unionByName(rows)
        if i + 1 < batches:
            snaps.append(build_snapshot(batch, groups, s, f"snap-{i}"))
    total = s.save(total.withColumn("first", F.when(F.col("same"), F.lit(-1)).otherwise(F.col("part"))), "groups")
    # a text known from an earlier batch joins that batch's group (at most one group per digest and batch)
    over = W.partitionBy("digest")
    lead = F.min(F.when(F.col("first") >= 0, F.col("first"))).over(over)
    home = F.when(F.col("first") < 0, lead).otherwise(F.col("first"))
    per = W.partitionBy("digest", "home")
    total = (total.withColumn("home", home)
             .select("digest", "part", F.min("keep").over(per).alias("keep_id"), F.sum("copies").over(per).alias("group_size"),
                     F.coalesce(F.min_by("keep_row", "keep").over(per), F.min("keep_row").over(per)).alias("keep_row")))
    total = s.save(total, "kept")  # a stored side lets Spark split a hot text of the join
    return (keyed.join(total, ["digest", "part"])
            .select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                    (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("digest")).alias("text_sha256")))
