"""Filter interaction audit by truth-table survival words.

Five filters give 32 subsets. A document that fails the filters of ``mask``
survives the subset ``s`` exactly if ``mask & s == 0``; the 32 answers are one
32-bit word (bit ``s``: survives subset ``s``). Counting the set bits of every bit
position over all words of a part gives the survivors of all subsets at once, and
every order, step, overlap and Shapley value is a difference of such counts.

1. One scan of the texts: digest of the text and the failed filters of its words
   and characters (A to D).
2. Documents that agree in text, part and labels share one word and are added up
   before the shuffle on the text, so thousands of copies are one row. Of each text
   the row(s) with the smallest id pass filter E, all others fail it.
3. Every task adds its words with carry-save adders: three words of one weight become
   one word of that weight and one carry of twice the weight, 32 positions at a time;
   a word that stands for n documents enters at the binary digits of n. What stays are
   a few words per weight, and their positional counts are summed per part and label.

Defined results: a null or empty text has no words and no characters (it fails A
only, or E); a null part is the empty string; a row with a null id never fails E
and makes no other row fail it; rows that repeat an id and its text are equals, so
both pass or both fail E; a document is good (toxic) if any of its label rows says
so, and unlabelled rows are neither; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quayside.llm import util as U

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Failure conditions: least words, least share of distinct words and largest share of capitals in per cent.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
CAPITALS = bytes(range(65, 91))
SYMBOLS = b"#$%&*|"
INNER = bytes(range(0x80, 0xC0))
GOOD, TOXIC = 1, 2
#: Word of every mask: bit s says whether subset s keeps the document.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not m & s) for m in range(SUBSETS)], np.uint32)
BATCH_WORDS = 1 << 18


def failed(text: bytes) -> int:
    """The failed filters A to D of a text as bits 0 to 3."""
    words = text.split()  # exactly U+0020 and U+0009 to U+000D
    chars = len(text.translate(None, INNER))
    out = int(len(words) < LEAST_WORDS)
    out |= (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
    out |= (100 * (len(text) - len(text.translate(None, CAPITALS))) > MOST_CAPITALS * chars) << 2
    return out | (len(text.translate(None, SYMBOLS)) < len(text)) << 3


def _scan(batches):
    """Arrow task: (id, part, text) to (id, part, digest, mask)."""
    for b in batches:
        data, offs = U.text_buffers(b.column(2))
        texts = (data[x:y].tobytes() for x, y in zip(offs[:-1], offs[1:], strict=True))
        rows = [(hashlib.sha256(t).digest(), failed(t)) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int32())],
            names=["id", "part", "digest", "mask"])


class Counter:
    """Positional counts of 32-bit words: ``planes[k]`` holds words of weight 2**k."""

    def __init__(self):
        self.planes: list[list[np.ndarray]] = []

    def _put(self, k: int, words: np.ndarray) -> None:
        while len(self.planes) <= k:
            self.planes.append([])
        if len(words):
            self.planes[k].append(words)

    def add(self, words: np.ndarray, times: np.ndarray) -> None:
        """Add every word as often as ``times`` says."""
        for k in range(int(times.max(initial=0)).bit_length()):
            self._put(k, words[(times >> k) & 1 == 1])
        self._carry()

    def _carry(self) -> None:
        k = 0
        while k < len(self.planes):
            w = np.concatenate(self.planes[k]) if self.planes[k] else np.zeros(0, np.uint32)
            self.planes[k] = []
            while len(w) > 2:
                n = len(w) // 3
                a, b, c = w[:n], w[n:2 * n], w[2 * n:3 * n]
                half = a ^ b
                self._put(k + 1, (a & b) | (c & half))
                w = np.concatenate([half ^ c, w[3 * n:]])
            self._put(k, w)
            k += 1

    def counts(self) -> list[int]:
        out = [0] * SUBSETS
        for k, words in enumerate(self.planes):
            for w in words:
                for x in w.tolist():
                    for s in range(SUBSETS):
                        out[s] += (x >> s & 1) << k
        return out


def _popcounts(batches):
    """Arrow task: (part, label, mask, n) to the positional counts of each part and label."""
    found: dict[tuple[str, int], Counter] = {}
    for b in batches:
        for at in range(0, b.num_rows, BATCH_WORDS):
            cut = b.slice(at, BATCH_WORDS)
            code = cut.column(0).dictionary_encode()
            label, mask, n = (cut.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            key = code.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 4 + label
            order = np.argsort(key, kind="stable")
            edges = np.flatnonzero(np.diff(key[order], prepend=-1))
            for i, j in zip(edges, [*edges[1:], len(key)], strict=True):
                rows = order[i:j]
                name = (code.dictionary[int(key[rows[0]]) // 4].as_py(), int(label[rows[0]]))
                found.setdefault(name, Counter()).add(WORDS[mask[rows]], n[rows].astype(np.int64))
    for (part, label), c in found.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([part]), pa.array([label], pa.int32()), pa.array([c.counts()], pa.list_(pa.int64()))],
            names=["part", "label", "kept"])


COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def order_rows(every: list[int], good: list[int], toxic: list[int]) -> list[tuple]:
    """(filter_order, step, the seven counts) of one part from its subset survivors."""
    full, n = SUBSETS - 1, len(FILTERS)
    orders = list(permutations(range(n)))
    shapley = [0] * n
    for o in orders:
        done = 0
        for f in o:
            shapley[f] += every[done] - every[done | 1 << f]
            done |= 1 << f
    out = []
    for o in orders:
        name, done = "".join(FILTERS[f] for f in o), 0
        for step, f in enumerate(o, 1):
            now = done | 1 << f
            gone = every[done] - every[now]
            out.append((name, step, every[now], gone, every[0] - every[1 << f] - gone, every[full ^ 1 << f] - every[full],
                        good[done] - good[now], toxic[done] - toxic[now], shapley[f]))
            done = now
    return out


def _report(batches):
    """Arrow task: (part, every, good, toxic) to the rows of all orders and steps."""
    for b in batches:
        for r in b.to_pylist():
            cols = list(zip(*order_rows(r["every"], r["good"], r["toxic"]), strict=True))
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * len(COUNTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["part"]] * len(cols[0])), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                names=["part", "filter_order", "step", *COUNTS])


def survival_words(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, label, mask, n``: how many documents of a part and label (bit 0: good,
    bit 1: toxic) have the same text or row class and fail the filters of ``mask``."""
    s = U.Scratch(spark, "audit")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                      F.col(text_col).cast("string").alias("text"))
    rows = s.save(src.mapInArrow(_scan, "id bigint, part string, digest binary, mask int"), "rows")
    marks = (labels.select(F.col("doc_id").cast("long").alias("id"), F.when(F.col("quality") == 1, GOOD).otherwise(0).alias("g"),
                           F.when(F.col("toxic") == 1, TOXIC).otherwise(0).alias("t"))
             .where("id is not null").groupBy("id").agg((F.max("g") + F.max("t")).alias("label")))
    known = (rows.where("id is not null").join(marks, "id", "left")
             .select("id", "part", "digest", "mask", F.coalesce("label", F.lit(0)).alias("label")))
    # copies within a part and label are one row before they meet those of other parts
    keys = ["digest", "part", "label", "mask"]
    once = known.groupBy("id", *keys).agg(F.count(F.lit(1)).alias("n"))
    alike = once.groupBy(*keys).agg(F.sum("n").alias("n"), F.min(F.struct("id", "n")).alias("first"))
    least = F.min("first.id").over(W.partitionBy("digest"))
    alike = alike.withColumn("pass", F.when(least == F.col("first.id"), F.col("first.n")).otherwise(0))
    last = 1 << len(FILTERS) - 1
    pairs = F.array(F.struct(F.col("mask").alias("mask"), F.col("pass").cast("long").alias("n")),
                    F.struct((F.col("mask") + last).alias("mask"), (F.col("n") - F.col("pass")).alias("n")))
    words = alike.select("part", "label", F.explode(pairs).alias("w")).select("part", "label", "w.mask", "w.n").where("n > 0")
    unnamed = rows.where("id is null").groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"))
    return words.union(unnamed.select("part", F.lit(0).alias("label"), "mask", "n"))


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per part, filter order and step: ``part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley``."""
    words = survival_words(spark, docs, labels, id_col, text_col, part_col)
    counted = words.select("part", "label", "mask", "n").mapInArrow(_popcounts, "part string, label int, kept array<bigint>")
    spread = counted.select("part", "label", F.posexplode("kept").alias("s", "n"))
    sums = spread.groupBy("part", "s").agg(
        F.sum("n").alias("every"), F.sum(F.when(F.col("label").bitwiseAND(GOOD) > 0, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("label").bitwiseAND(TOXIC) > 0, F.col("n")).otherwise(0)).alias("toxic"))
    # 32 numbers a part
    per = sums.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("s", "every", "good", "toxic"))).alias("x"))
    per = per.select("part", F.col("x.every").alias("every"), F.col("x.good").alias("good"), F.col("x.toxic").alias("toxic"))
    names = "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return per.mapInArrow(_report, names)
