"""Substring deduplication by level-wise doubling.

A *window* is ``window`` consecutive words of one document. Every word covered by
a window whose word sequence also starts in a document with a smaller id is
removed (all windows are judged on the input).

Method: look for repeated short windows first and extend only those, level by level,
at lengths that double up to the window (``lengths``), until none survives.

* At a length below the window, the short window with the smallest hash stands for
  the full window around it. Equal full windows choose equal short ones, so a full
  window can only repeat if its short window occurs in two different documents. The
  first level counts the short windows of every full window (about one position in
  20 at a quarter of the length); each later level only those of full windows whose
  short window repeated at the level before.
* The last length is the window itself: full windows whose short window repeats are
  hashed (128 bits) and grouped to the smallest id that holds them.
* A longer repeated window is covered by its repeated windows of the asked
  length, so a further doubling changes no removed word and none is run.

Documents with the same word sequence are one class: all but the row(s) with
the smallest id lose every word of every window at once, and only that row's
windows are counted, so thousands of copies cost one.

Counts are partial aggregations and the smallest ids return by joins, so a
passage shared by very many documents is never gathered in one task.

Defined results: null and wordless texts have no words and lose none; a text of
fewer than ``window`` words loses none; rows with a null id lose nothing and
take nothing from others (they have no place in the id order); repeated rows
(same id and words) get equal results.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    if len(h) < width:
        return h[:0]
    span, m = 1, h
    while span * 2 <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[:len(h) - width + 1], m[width - span:width - span + len(h) - width + 1])


def _stand_ins(h: np.ndarray, window: int, short: int) -> np.ndarray:
    """For each full-window start, the hash of its smallest short window."""
    return sliding_min(U.window_hashes(h, short), window - short + 1)


def lengths(window: int) -> list[int]:
    """Window lengths of the levels; each is at most twice the one before."""
    return sorted({-(-window // 4), -(-window // 2), window})


def _runs(values: np.ndarray) -> np.ndarray:
    """First value of every run of equal values, without repeats."""
    if not len(values):
        return values
    first = np.ones(len(values), bool)
    first[1:] = values[1:] != values[:-1]
    return np.unique(values[first])


def _scan(window: int, short: int):
    """Arrow task: id, digest of the words, number of words, stand-in hashes."""
    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(1))
            for i, j in U.chunks(offs):
                part = offs[i:j + 1]
                h, rows = U.word_hashes(data, part)
                m = _stand_ins(h, window, short)
                sigs, lists = [], []
                for r in range(j - i):
                    words = data[part[r]:part[r + 1]].tobytes().split()
                    sigs.append(hashlib.sha256(b" ".join(words)).digest())
                    a, e = int(rows[r]), int(rows[r + 1])
                    lists.append(_runs(m[a:max(e - window + 1, a)]))
                lens = np.array([len(x) for x in lists], np.int64)
                flat = U.signed(np.concatenate(lists)) if lists else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(sigs, pa.binary()), pa.array(np.diff(rows)),
                     U.list_column(flat, lens, pa.int64())], names=["id", "sig", "n", "shorts"])
    return run


def _fetch(only: np.ndarray):
    """Arrow task: texts of ids that the filter may hold, with the digest of their words."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            hit = U.might_hold(only, ids.fill_null(0).to_numpy(zero_copy_only=False)) & np.asarray(ids.is_valid())
            b = b.filter(pa.array(hit))
            data, offs = U.text_buffers(b.column(1))
            sigs = [hashlib.sha256(b" ".join(data[offs[r]:offs[r + 1]].tobytes().split())).digest() for r in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.binary()), b.column(1)], names=["id", "sig", "text"])
    return run


def _survivors(b: pa.RecordBatch, window: int, short: int):
    """Of a batch (id, text, repeated shorts), by pieces of rows: the range of rows, the
    bounds of their texts, word hashes, first words, and the starts of the full windows
    that a repeated short window stands for."""
    data, offs = U.text_buffers(b.column(1))
    shorts = b.column(2)
    so = shorts.offsets.to_numpy()
    sv = shorts.values.to_numpy(zero_copy_only=False).view(U.U64)
    for i, j in U.chunks(offs):
        part = offs[i:j + 1]
        h, rows = U.word_hashes(data, part)
        m = _stand_ins(h, window, short)
        ok = np.zeros(len(m), bool)
        for a, e in zip(rows[:-1], rows[1:] - window + 1, strict=True):
            ok[a:max(e, a)] = True
        ok &= np.isin(m, np.unique(sv[so[i]:so[j]]))
        yield i, j, data, part, h, rows, np.flatnonzero(ok)


def _double(window: int, short: int, length: int):
    """Arrow task: (id, text, repeated shorts) to the short windows of the next length."""
    def run(batches):
        for b in batches:
            for i, j, _, _, h, rows, at in _survivors(b, window, short):
                m = _stand_ins(h, window, length)[at] if len(at) else np.zeros(0, U.U64)
                cut = np.searchsorted(at, rows)
                lists = [_runs(m[x:y]) for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), U.list_column(U.signed(np.concatenate(lists)), np.array([len(x) for x in lists]), pa.int64())],
                    names=["id", "shorts"])
    return run


def _extend(window: int, short: int):
    """Arrow task: (id, text, repeated shorts) to the full windows they stand for."""
    def run(batches):
        for b in batches:
            for i, j, data, part, h, rows, at in _survivors(b, window, short):
                g, _ = U.word_hashes(data, part, base=U.BASE_B)
                one = U.window_hashes(h, window)[at] if len(at) else np.zeros(0, U.U64)
                two = U.window_hashes(g, window, base=U.BASE_A)[at] if len(at) else np.zeros(0, U.U64)
                cut = np.searchsorted(at, rows)
                lens = np.diff(cut)
                base = np.repeat(rows[:-1], lens)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), U.list_column((at - base).astype(np.int32), lens, pa.int32()),
                     U.list_column(U.signed(one), lens, pa.int64()), U.list_column(U.signed(two), lens, pa.int64())],
                    names=["id", "pos", "one", "two"])
    return run


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:n]) > 0


def _cut(window: int):
    """Arrow task: (sig, text, window starts) to the words that stay."""
    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(1))
            kept, removed, shas = [], [], []
            for r in range(b.num_rows):
                words = data[offs[r]:offs[r + 1]].tobytes().split()
                gone = covered(len(words), np.asarray(b.column(2)[r].as_py(), np.int64), window)
                text = b" ".join([w for w, g in zip(words, gone, strict=True) if not g])
                kept.append(text.decode())
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(kept, pa.string()), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                names=["sig", "kept_text", "n_removed", "kept_sha256"])
    return run


def _repeated(s: U.Scratch, marks: DataFrame, length: int) -> DataFrame:
    """(id, shorts): the short windows of ``marks`` (id, h) that another id holds too."""
    twice = marks.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h")
    twice = s.save(twice, f"repeated-{length}")  # a stored side lets Spark split a hot key of the join
    return s.save(marks.join(twice, "h").groupBy("id").agg(F.collect_set("h").alias("shorts")), f"live-{length}")


def substring_dedup(spark: SparkSession, docs: DataFrame, window: int = 50, id_col: str = "doc_id",
                    text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256`` and, with
    ``texts``, ``kept_text``: the words that stay joined by one space (null where
    nothing is removed, so an untouched text is used as it is) and ``words_sig``, the
    SHA-256 of the input's words joined by one space."""
    s = U.Scratch(spark, "substring")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    levels = lengths(window)
    short = levels[0]
    base = s.save(src.mapInArrow(_scan(window, short), "id bigint, sig binary, n bigint, shorts array<bigint>"), "base")
    classes = base.where("id is not null").groupBy("sig").agg(F.min("id").alias("rep"))
    classes = s.save(classes, "classes")

    # the first level: short windows that occur in two classes
    firsts = base.where(F.size("shorts") > 0).select("sig", "id", "shorts").join(
        classes.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi")
    live = _repeated(s, firsts.select("id", F.explode("shorts").alias("h")), short)
    texts_ = s.save(src.mapInArrow(_fetch(U.id_filter(live, "id")), "id bigint, sig binary, text string")
                    .join(classes.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi")
                    .join(live.select("id"), "id", "left_semi"), "texts")

    # twice the length, for what repeats, until nothing does or the window is reached
    for length in levels[1:-1]:
        if live.isEmpty():
            break
        found = s.save(texts_.select("id", "text").join(live, "id").select("id", "text", "shorts")
                       .mapInArrow(_double(window, short, length), "id bigint, shorts array<bigint>"), f"shorts-{length}")
        live, short = _repeated(s, found.select("id", F.explode("shorts").alias("h")), length), length
        s.drop(f"shorts-{length}")

    # the last level: full windows that a repeated short window stands for
    texts_ = s.save(texts_.join(live, "id"), "open")
    s.drop("texts")
    # the class goes along: one id may stand for several texts
    wins = (texts_.select(F.struct("id", "sig").alias("id"), "text", "shorts")
            .mapInArrow(_extend(window, short), "id struct<id: bigint, sig: binary>, pos array<int>, one array<bigint>, two array<bigint>")
            .select("id.id", "id.sig", F.explode(F.arrays_zip("pos", "one", "two")).alias("w"))
            .select("id", "sig", "w.pos", "w.one", "w.two"))
    owner = wins.groupBy("one", "two").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").drop("hi")
    owner = s.save(owner, "owners")
    gone = (wins.join(owner, ["one", "two"]).where("lo < id").groupBy("id", "sig").agg(F.collect_set("pos").alias("pos")))
    cut = (texts_.select("id", "sig", "text").join(gone, ["id", "sig"]).select("sig", "text", "pos")
           .mapInArrow(_cut(window), "sig binary, kept_text string, n_removed bigint, kept_sha256 string")
           .dropDuplicates(["sig"]))
    if not texts:
        cut = cut.drop("kept_text")
    cut = s.save(cut, "cut")

    per_class = classes.join(cut, "sig", "left")
    whole = F.col("id").isNotNull() & (F.col("rep") < F.col("id")) & (F.col("n") >= window)
    mine = F.col("id").isNotNull() & (F.col("rep") == F.col("id")) & F.col("n_removed").isNotNull()
    out = base.select("id", "sig", "n").join(per_class, "sig", "left")
    cols = [F.col("id").alias("doc_id"), F.col("n").alias("n_words"),
            F.when(whole, F.col("n")).when(mine, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
            F.when(whole, F.lit(EMPTY_SHA)).when(mine, F.col("kept_sha256")).otherwise(F.lower(F.hex("sig"))).alias("kept_sha256")]
    if texts:
        cols.append(F.when(whole, F.lit("")).when(mine, F.col("kept_text")).alias("kept_text"))
        cols.append(F.col("sig").alias("words_sig"))
    return out.select(*cols)
