"""N-gram Jaccard self-join by a grouped prefix join.

Two documents link when the Jaccard similarity of their shingle sets is at least
``num/den``. All comparisons are in integers (``den * overlap >= num * union``).

Method, every step exact:

1. Each text becomes its set of hashed shingles. Equal sets form one *class*
   (their documents are linked to each other, n >= 1); only classes go on.
2. A set can miss at most ``n - ceil(t * n)`` of its shingles in a partner. A
   fixed part of the hash space is counted over all documents: classes with
   more shingles there that no other class holds have no partner and stop.
3. The shingles of the remaining classes are ordered by document frequency, rarest
   first. Linked sets share a shingle among the first ``n - ceil(t * n) + 1`` of each;
   shingles that one class alone holds take places there but no postings.
4. Classes with identical (shared) prefixes and size are collapsed into one
   *group*; the posting lists hold groups. Pairs of groups are filtered by size and
   by the position of the shared shingle.
5. Pairs are expanded and members verified on the whole sets, in an order that
   keeps a large group of near copies linear: first members against the lead of
   their group, and each group against the group with the fewest lone shingles
   in its posting lists; then leads of groups that aren't yet connected; then all
   members of groups that still aren't. Every pair of classes is verified, ruled out
   by a filter, or already connected, so the components are exact.

Defined results: null or wordless texts have an empty set and no link; a text of
fewer than ``k`` words is one shingle; rows with a null id get a set size and a
null component; repeated rows fall in one class; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.llm.components import components, merged

# Part of the 64-bit hash space whose shingles are counted for the first test, as
# a multiple of the share that a partner may lack.
TEST_FACTOR = 1.75

# Bytes of texts or sets that go to a Python worker at a time.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

SETS = "id bigint, sig binary, n bigint, tokens array<bigint>"


def _limit(share: float) -> int:
    return min(int(share * 2.0 ** 64), 2 ** 64 - 1)


def _need(n, num: int, den: int):
    """Smallest whole number of at least n * num / den."""
    return (n * num + den - 1) // den


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int):
    """Sorted distinct shingle hashes of each row, as one array and row lengths."""
    h, rows = U.word_hashes(data, offs, lower=True)
    grams = U.window_hashes(h, k)
    out, counts = [], np.zeros(len(rows) - 1, np.int64)
    for r in range(len(rows) - 1):
        a, b = int(rows[r]), int(rows[r + 1])
        if b - a >= k:
            u = np.unique(grams[a:b - k + 1])
        elif b > a:
            u = U.window_hashes(h[a:b], b - a) ^ U.U64(0xA5A5A5A5 + b - a)
        else:
            u = np.zeros(0, U.U64)
        out.append(u)
        counts[r] = len(u)
    return out, counts


def _scan(k: int, share: float | None, only: np.ndarray | None = None):
    """Arrow task: texts to sets. ``share``: keep the tokens of that part of the
    hash space (None: all). ``only``: an id filter; other rows are skipped."""
    cut = None if share is None else U.U64(_limit(share))

    def run(batches):
        for b in batches:
            if only is not None:
                ids = b.column(0)
                hit = U.might_hold(only, ids.fill_null(0).to_numpy(zero_copy_only=False)) & ~np.asarray(ids.is_null())
                b = b.filter(pa.array(hit))
            data, offs = U.text_buffers(b.column(1))
            for i, j in U.chunks(offs):
                sets, counts = shingle_sets(data, offs[i:j + 1], k)
                sigs = [hashlib.blake2b(s, digest_size=16).digest() if len(s) else None for s in sets]
                if cut is not None:
                    kept = [s[:np.searchsorted(s, cut)] for s in sets]
                else:
                    kept = sets
                lens = np.array([len(s) for s in kept], np.int64)
                flat = U.signed(np.concatenate(kept)) if kept else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(sigs, pa.binary()), pa.array(counts),
                     U.list_column(flat, lens, pa.int64())], names=["id", "sig", "n", "tokens"])
    return run


def _prefixes(num: int, den: int):
    """Arrow task: (c, n, lone, shared {df, token}) to the shared prefix and the group key."""
    def run(batches):
        for b in batches:
            ns, lones = b.column(1).to_numpy(), b.column(2).to_numpy()
            flat, offs = b.column(3).flatten(), b.column(3).offsets.to_numpy()
            offs = offs - offs[0]
            dfs = flat.field("df").to_numpy(zero_copy_only=False)
            toks = flat.field("token").to_numpy(zero_copy_only=False)
            keys, lines, places, lens = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], []
            for r in range(b.num_rows):
                n, lone = int(ns[r]), int(lones[r])
                df, tok = dfs[offs[r]:offs[r + 1]], toks[offs[r]:offs[r + 1]]
                line = tok[np.lexsort((tok, df))][:n - _need(n, num, den) + 1 - lone]
                place = np.arange(lone, lone + len(line), dtype=np.int32)
                keys.append(hashlib.blake2b(b"".join((n.to_bytes(8, "little"), lone.to_bytes(8, "little"), line.tobytes())),
                                            digest_size=16).digest())
                lines.append(line)
                places.append(place)
                lens.append(len(line))
            lens = np.array(lens, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(keys, pa.binary()),
                 U.list_column(np.concatenate(lines), lens, pa.int64()), U.list_column(np.concatenate(places), lens, pa.int32())],
                names=["c", "n", "lone", "g", "line", "pos"])
    return run


def _overlaps(num: int, den: int):
    """Arrow task: overlap of the whole sets of each pair, and whether they link."""
    def run(batches):
        for b in batches:
            both, ok = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, bool)
            left, right = b.column(2), b.column(3)
            for r in range(b.num_rows):
                x = left[r].values.to_numpy(zero_copy_only=False)
                y = right[r].values.to_numpy(zero_copy_only=False)
                both[r] = len(np.intersect1d(x, y, assume_unique=True))
                ok[r] = den * both[r] >= num * (len(x) + len(y) - both[r])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both), pa.array(ok)], names=["u", "v", "both", "ok"])
    return run


def _thin(sets: DataFrame, only: np.ndarray) -> DataFrame:
    """Sets whose class may occur in the filter (ahead of the exact join)."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(U.might_hold(only, b.column(0).to_numpy(zero_copy_only=False))))
    return sets.select("c", "tokens").mapInArrow(run, "c bigint, tokens array<bigint>")


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Candidate class pairs (u, v) with their overlap and whether they link."""
    a = _thin(sets, U.id_filter(pairs, "u")).select(F.col("c").alias("u"), F.col("tokens").alias("x"))
    b = _thin(sets, U.id_filter(pairs, "v")).select(F.col("c").alias("v"), F.col("tokens").alias("y"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "x", "y")
            .mapInArrow(_overlaps(num, den), "u bigint, v bigint, both bigint, ok boolean"))


def class_sigs(texts: DataFrame, k: int) -> DataFrame:
    """``key, class_sig`` for every row of (key binary, text)."""
    return (texts.mapInArrow(_scan(k, 0.01), SETS.replace("id bigint", "id binary"))
            .select(F.col("id").alias("key"), F.col("sig").alias("class_sig")))


def jaccard_components(spark: SparkSession, docs: DataFrame, k: int = 5, num: int = 4, den: int = 5,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, class_sig``.

    ``k`` words per shingle and similarity ``num/den`` (0.8 by default).
    ``component_id`` is the smallest id reachable by links; ``class_sig`` is equal
    for rows with equal sets (null for empty sets).
    """
    if not 0 < num <= den:
        raise ValueError("similarity must lie in (0, 1]")
    s = U.Scratch(spark, "jaccard", BATCH)
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    share = min(1.0, TEST_FACTOR * (den - num) / den) or 0.01

    base = s.save(src.mapInArrow(_scan(k, share), SETS), "base")
    rows = base.count()
    # classes: equal sets; c is a 64-bit form of the 128-bit signature
    c = F.conv(F.substring(F.hex("sig"), 2, 15), 16, 10).cast("long")
    classes = s.save(base.where("sig is not null").groupBy("sig")
                     .agg(F.min("id").alias("rep"), F.first("n").alias("n")).where("rep is not null")
                     .withColumn("c", c), "classes", rows=rows)

    # 2. shingles of the tested part that only one class holds
    missing = F.col("n") - F.floor((F.col("n") * num + den - 1) / den)
    lone = (base.where("sig is not null and id is not null").select(c.alias("c"), F.explode("tokens").alias("token"))
            .groupBy("token").agg(F.min("c").alias("c"), F.max("c").alias("other"))
            .where("c = other").groupBy("c").agg(F.count(F.lit(1)).alias("lone")))
    alive = s.save(classes.join(lone, "c", "left").where(F.coalesce("lone", F.lit(0)) <= missing)
                   .select("c", "rep"), "alive", rows=rows)

    # 3. whole sets of the remaining classes, and the order of their shingles
    only = U.id_filter(alive, "rep")
    same = W.partitionBy("c", "id").orderBy("n")
    sets = s.save(src.mapInArrow(_scan(k, None, only), SETS).withColumn("c", c)
                  .join(alive.select("c", F.col("rep").alias("id")), ["c", "id"], "left_semi")
                  .withColumn("rn", F.row_number().over(same)).where("rn = 1").select("c", "n", "tokens"), "sets")
    tokens = sets.select("c", F.explode("tokens").alias("token"))
    freq = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    freq = s.save(freq, "frequencies")  # a stored side lets Spark split a hot key of the join
    shared = tokens.join(freq, "token").groupBy("c").agg(
        F.collect_list(F.struct("df", "token")).alias("shared"), F.count(F.lit(1)).alias("known"))
    ready = (sets.select("c", "n").join(shared, "c").withColumn("lone", F.col("n") - F.col("known"))
             .where(F.col("lone") <= missing).select("c", "n", "lone", "shared"))
    members = s.save(ready.mapInArrow(_prefixes(num, den), "c bigint, n bigint, lone bigint, g binary, line array<bigint>, pos array<int>"), "members")

    # 4. groups, and the posting lists of their prefixes
    lead = members.groupBy("g").agg(F.min("c").alias("lead"), F.count(F.lit(1)).alias("size"))
    groups = s.save(members.join(lead.withColumnRenamed("lead", "c"), ["g", "c"])
                    .select("g", F.col("c").alias("lead"), "size", "n", "lone", "line", "pos"), "groups")
    post = (groups.select("g", "lead", "size", "n", "lone", F.explode(F.arrays_zip("line", "pos")).alias("e"))
            .select("g", "lead", "size", "n", "lone", F.col("e.line").alias("line"), F.col("e.pos").alias("pos")))

    def fits(a: str, b: str):
        """Size and position filters of two postings (column suffixes)."""
        n1, n2 = F.col(f"n{a}"), F.col(f"n{b}")
        overlap = F.floor((num * (n1 + n2) + num + den - 1) / (num + den))
        return ((n1 * num <= n2 * den) & (n2 * num <= n1 * den)
                & (F.least(n1 - F.col(f"pos{a}"), n2 - F.col(f"pos{b}")) >= overlap))

    def side(frame: DataFrame, suffix: str) -> DataFrame:
        return frame.select("line", *[F.col(x).alias(x + suffix) for x in frame.columns if x != "line"])

    # 5a. members against their group's lead; each group against the group with the fewest
    # lone shingles in its posting lists (the text that near copies were made from has none)
    hub = post.groupBy("line").agg(F.min(F.struct("lone", "g", "lead", "n", "pos")).alias("h"), F.count(F.lit(1)).alias("k"))
    hub = hub.where("k > 1").select("line", *[F.col(f"h.{x}").alias(x + "2") for x in ("g", "lead", "n", "pos")])
    stars = (side(post, "1").join(hub, "line").where((F.col("g1") != F.col("g2")) & fits("1", "2"))
             .select(F.least("lead1", "lead2").alias("u"), F.greatest("lead1", "lead2").alias("v"))
             .union(members.join(groups.where("size > 1").select("g", "lead"), "g").where("c <> lead")
                    .select(F.col("lead").alias("u"), F.col("c").alias("v"))).distinct())
    stars = s.save(stars, "stars", rows=rows)
    seen1 = s.save(_verify(stars, sets, num, den), "verified-1")
    edges1 = seen1.where("ok").select("u", "v")
    labels = s.save(components(edges1, s, "cc1", rows), "labels-1", rows=rows)

    def apart(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members with their labels, and pairs of groups that aren't one component. In a
        posting list only groups outside its largest label meet the others."""
        mem = (members.select("g", "c").join(labels.select(F.col("node").alias("c"), "component"), "c", "left")
               .select("g", "c", F.coalesce("component", "c").alias("label")))
        ends = mem.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
        marked = post.drop("lone").join(ends, "g")
        per = marked.groupBy("line", "lo").agg(F.max("hi").alias("hi"), F.count(F.lit(1)).alias("k"))
        open_ = (per.groupBy("line").agg(F.min("lo").alias("a"), F.max("hi").alias("b"), F.max_by("lo", "k").alias("main"))
                 .where("a <> b").select("line", "main"))
        marked = s.save(marked.join(open_, "line"), f"open-{uuid.uuid4().hex[:6]}")
        small = side(marked.where("lo <> main or lo <> hi").drop("main"), "1")
        met = (small.join(side(marked.drop("main"), "2"), "line")
               .where((F.col("g1") != F.col("g2")) & fits("1", "2") & ~F.expr("lo1 = hi1 and lo2 = hi2 and lo1 = lo2")))
        return mem, met

    # 5b. leads of groups that aren't connected yet
    mem, met = apart(labels)
    ab = s.save(met.select(F.least("lead1", "lead2").alias("u"), F.greatest("lead1", "lead2").alias("v")).distinct()
                .join(stars, ["u", "v"], "left_anti"), "leads", rows=rows)
    seen2 = s.save(_verify(ab, sets, num, den), "verified-2")
    edges2 = seen2.where("ok").select("u", "v")
    if not edges2.isEmpty():
        labels = s.save(merged(labels, edges2, s, "cc2", rows), "labels-2", rows=rows)
        mem, met = apart(labels)

    # 5c. all member pairs between what is still apart. A member shares with another no more
    # than the leads share and both have beyond their lead (lone shingles don't count).
    pair = [F.least("lead1", "lead2").alias("u"), F.greatest("lead1", "lead2").alias("v")]
    wide = (met.where("size1 > 1 or size2 > 1")
            .select(F.least("g1", "g2").alias("g1"), F.greatest("g1", "g2").alias("g2"), (F.col("n1") + F.col("n2")).alias("n"), *pair)
            .distinct().join(seen1.union(seen2).select("u", "v", "both"), ["u", "v"]).select("g1", "g2", "n", "both")
            .union(mem.groupBy("g").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
                   .join(groups.select("g", "n", "lone"), "g")
                   .select(F.col("g").alias("g1"), F.col("g").alias("g2"), (F.col("n") * 2).alias("n"), (F.col("n") - F.col("lone")).alias("both"))))
    wide = s.save(wide, "wide", rows=rows)
    own = members.join(groups.where("size > 1").select("g", "lead"), "g").where("c <> lead").select(
        F.col("lead").alias("u"), F.col("c").alias("v"), "n", "lone")
    beyond = own.join(seen1, ["u", "v"]).select(F.col("v").alias("c"), (F.col("n") - F.col("both") - F.col("lone")).alias("extra"))
    mem = s.save(mem.join(beyond, "c", "left").select("g", "c", "label", F.coalesce("extra", F.lit(0)).alias("extra")), "expandable", rows=rows)
    m1 = mem.select(F.col("g").alias("g1"), F.col("c").alias("u"), F.col("label").alias("l1"), F.col("extra").alias("e1"))
    m2 = mem.select(F.col("g").alias("g2"), F.col("c").alias("v"), F.col("label").alias("l2"), F.col("extra").alias("e2"))
    need = F.floor((num * F.col("n") + num + den - 1) / (num + den))
    rest = (wide.join(m1, "g1").join(m2, "g2")
            .where((F.col("l1") != F.col("l2")) & (F.col("both") + F.col("e1") + F.col("e2") >= need)
                   & ((F.col("g1") != F.col("g2")) | (F.col("u") < F.col("v"))))
            .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    rest = s.save(rest, "expanded")
    edges3 = s.save(_verify(rest, sets, num, den), "verified-3").where("ok").select("u", "v")
    if not edges3.isEmpty():
        labels = s.save(merged(labels, edges3, s, "cc3", rows), "labels-3", rows=rows)

    # smallest id of each component, back to the classes and to every row
    linked = classes.join(labels.select(F.col("node").alias("c"), "component"), "c")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    found = linked.join(least, "component").select("sig", "least")
    per_class = classes.join(found, "sig", "left").select("sig", F.coalesce("least", "rep").alias("least"))
    return (base.select("id", "sig", "n").join(per_class, "sig", "left")
            .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                    F.when(F.col("id").isNotNull(), F.coalesce("least", "id")).alias("component_id"),
                    F.col("sig").alias("class_sig")))
