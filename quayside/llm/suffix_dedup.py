"""Suffix-array deduplication of bytes by distributed prefix doubling.

Every byte covered by a ``window``-byte string that also starts earlier (in a
document with a smaller id, or earlier in the same document) is removed.

A suffix array need not be sorted past ``window`` bytes, and a position whose prefix
is unique can never repeat, so positions are ranked at growing lengths and leave as
soon as they are unique. A rank here is a name: equal strings, equal names.

* Up to half the window the doubling is local: the name of ``2h`` bytes is made of
  the pair of names at ``p`` and ``p + h``, from single bytes to 8 (the bytes
  themselves), 16, 32 and ``window / 2``.
* First level, ``window / 2`` bytes: of the short strings in each window the one with
  the smallest name stands for the window, wherever the window occurs. Spark sorts
  (name, document) of the stand-ins, about one position in 25, over all documents; names
  of a single document leave, and with them all windows they stand for.
* Then, at one half, three quarters and all of the window: consecutive windows with one
  stand-in are a run of at most ``RUN`` positions, named by its stand-in and the pair of
  the names of its first and last window. Spark ranks (stand-in, pair) over the
  documents. A run that an earlier document holds as well goes as a whole; a run whose
  stand-in has no other pair is settled; the rest (the edges of repeated regions) goes on
  to the next length. At the full length every run is settled, and the levels
  end as soon as none is left.

Earlier starts in the same document are found in the task that holds its text. Documents
with equal text are one class: all but the row(s) with the smallest id lose
everything if they are at least ``window`` bytes long, so thousands of copies cost one.

A name is 64 bits of a non-linear mix of pairs where it only decides what is looked at,
and 128 bits where it decides what goes. Smallest ids are partial aggregates and return by joins, so a passage in
very many documents is never gathered in one task. Long texts are read in segments.

Defined results: null counts as empty; texts shorter than ``window`` bytes lose nothing;
rows with a null id lose nothing and take nothing from others (they have no place
in the order); of rows with one id and different texts neither is earlier; repeated
rows (same id and text) get equal results; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
LANES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
RUN = 64
#: Positions named at once (their arrays stay in the processor's cache) and bytes of a piece of a batch.
SEGMENT, CHUNK = 1 << 16, 1 << 20


def pair(x: np.ndarray, y: np.ndarray, lane: int = 0) -> np.ndarray:
    """Name of a pair of names."""
    z = y * U.U64(LANES[lane])
    z ^= z >> U.U64(32)
    z += x
    z *= U.U64(LANES[1 - lane])
    z ^= z >> U.U64(29)
    return z


def names(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Name of the ``length`` bytes at every position by doubling, and the bytes of the last
    step below 16 (8 where ``length`` is at least that)."""
    f, h = data.astype(U.U64), 1
    while h < 8 and 2 * h <= length:
        f = f[:max(len(f) - h, 0)] | f[h:] << U.U64(8 * h)
        h *= 2
    words = f
    while h < length:
        step = min(h, length - h)
        f = pair(f[:max(len(f) - step, 0)], f[step:])
        h += step
    return f, words


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    span, m = 1, h
    while span < width and len(m):
        step = min(span, width - span)
        m = np.minimum(m[:max(len(m) - step, 0)], m[step:])
        span += step
    return m


class Runs:
    """The runs among the window starts ``ok`` of a segment: first and last start, stand-in."""

    def __init__(self, part: np.ndarray, ok: np.ndarray, window: int, length: int):
        self.window, self.length = window, length
        self.names, self.words = names(part, length)
        self.width = window - length + 1
        self.least = sliding_min(self.names, self.width)
        self.split(ok)

    def split(self, ok: np.ndarray) -> None:
        """Make the runs of the window starts ``ok``."""
        m, n = self.least, len(self.least)
        ok = ok[:n]
        first = ok.copy()
        first[1:] &= ~ok[:-1] | (m[1:] != m[:-1])
        # every run is cut after RUN positions
        inside = np.arange(n)
        inside -= np.maximum.accumulate(np.where(first, inside, 0))
        first = ok & (first | (inside % RUN == 0))
        last = ok.copy()
        last[:-1] &= ~ok[1:] | first[1:]
        self.lo, self.hi = np.flatnonzero(first), np.flatnonzero(last)
        self.short = m[self.lo]

    def keep(self, which: np.ndarray) -> None:
        self.lo, self.hi, self.short = self.lo[which], self.hi[which], self.short[which]

    def twice(self) -> np.ndarray:
        """Runs in which the stand-in occurs twice."""
        inside = np.arange(self.width)
        first, last = ((self.names[at[:, None] + inside] == self.short[:, None]) for at in (self.lo, self.hi))
        return self.lo + first.argmax(axis=1) < self.hi + self.width - 1 - last[:, ::-1].argmax(axis=1)

    def full(self, at: np.ndarray) -> list[np.ndarray]:
        """Names of the windows that start at ``at``, both lanes."""
        one = pair(self.names[at], self.names[at + self.window - self.length])
        size = min(8, 1 << self.window.bit_length() - 1)
        steps = [*range(0, self.window - size, size), self.window - size]
        two = self.words[at]
        for k in steps[1:]:
            two = pair(two, self.words[at + k], 1)
        return [one, two]

    def pairs(self) -> list[np.ndarray]:
        """Names of the runs, both lanes."""
        size = (self.hi - self.lo).astype(U.U64)
        return [pair(pair(x, y, k), size, k) for k, (x, y) in enumerate(zip(self.full(self.lo), self.full(self.hi), strict=True))]

    def positions(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All window starts of ``runs``, and the run of each."""
        n = (self.hi - self.lo + 1)[runs]
        run = np.repeat(runs, n)
        return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + self.lo[run], run


def every_start(offs: np.ndarray, window: int) -> np.ndarray:
    """Marks of all bytes of the rows at which a window of a row starts."""
    base, edge = int(offs[0]), np.zeros(int(offs[-1] - offs[0]) + 1, np.int32)
    ends = offs[1:] - window + 1
    has = ends > offs[:-1]
    edge[offs[:-1][has] - base] += 1
    edge[ends[has] - base] -= 1
    return np.cumsum(edge[:-1]) > 0


def segments(data: np.ndarray, ok: np.ndarray, window: int, length: int) -> Iterator[tuple[int, Runs]]:
    """The runs of pieces of ``data`` whose window starts are marked, and where each piece begins."""
    for x in range(0, len(data), SEGMENT):
        mine = ok[x:x + SEGMENT]
        if mine.any():
            yield x, Runs(data[x:x + SEGMENT + window - 1], mine, window, length)


def _distinct(rows: np.ndarray, cols: list[np.ndarray], n: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct (row, values) in order of rows, how many each row has, how often each occurs."""
    order = np.lexsort([*cols[::-1], rows])
    keys = [rows[order], *[c[order] for c in cols]]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(order)))
    return [k[at] for k in keys], np.bincount(keys[0][at], minlength=n), times


def _longs(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    return U.list_column(U.signed(np.ascontiguousarray(values)), counts, pa.int64())


def _stand_ins(data: np.ndarray, cut: np.ndarray, window: int, short: int):
    """Distinct (row, stand-in) of the rows, how many each row has, and which occur twice in their row."""
    base = int(cut[0])
    rows, shorts = [np.zeros(0, np.int64)], [np.zeros(0, U.U64)]
    for x, r in segments(data[base:cut[-1]], every_start(cut, window), window, short):
        row, more = np.searchsorted(cut, r.lo + x + base, side="right") - 1, r.twice()
        rows += [row, row[more]]
        shorts += [r.short, r.short[more]]
    keys, n, times = _distinct(np.concatenate(rows), [np.concatenate(shorts)], len(cut) - 1)
    return keys, n, times > 1


def _scan(window: int, short: int):
    """Arrow task: id, text to id, digest, bytes, stand-ins and those that occur twice in the text."""
    def run(batches):
        for b in batches:
            text = b.column(1).fill_null("")
            data, offs = U.text_buffers(text)
            for i, j in U.chunks(offs, CHUNK):
                cut = offs[i:j + 1]
                keys, n, own = _stand_ins(data, cut, window, short)
                sigs = [hashlib.sha256(data[x:y]).digest() for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(sigs, pa.binary()), pa.array(np.diff(cut)), _longs(keys[1], n),
                     _longs(keys[1][own], np.bincount(keys[0][own], minlength=j - i))],
                    names=["id", "sig", "n", "shorts", "own"])
    return run


def _shared(batches):
    """Arrow task: (h, id) in sorted order to those rows whose h several ids hold, or whose h
    reaches the edge of a batch (its other rows are elsewhere; the next level decides)."""
    for b in batches:
        h, i = (b.column(k).to_numpy() for k in (0, 1))
        if len(h):
            begin = np.flatnonzero(np.diff(h, prepend=h[0] - 1))
            end = np.append(begin[1:], len(h)) - 1
            some = i[begin] != i[end]
            some[[0, -1]] = True
            yield b.filter(pa.array(np.repeat(some, end - begin + 1)))


def _fetch(only: np.ndarray):
    """Arrow task: texts of ids that the filter may hold, with their digest."""
    def run(batches):
        for b in batches:
            ids = b.column(0)
            hit = U.might_hold(only, ids.fill_null(0).to_numpy(zero_copy_only=False)) & np.asarray(ids.is_valid())
            b = b.filter(pa.array(hit))
            data, offs = U.text_buffers(b.column(1))
            sigs = [hashlib.sha256(data[x:y]).digest() for x, y in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sigs, pa.binary()), b.column(1)], names=["id", "sig", "text"])
    return run


def _again(rows: np.ndarray, cols: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """The positions ``at`` whose (row, values) occur at a smaller position as well."""
    order = np.lexsort([at, *cols[::-1], rows])
    same = np.ones(max(len(order) - 1, 0), bool)
    for c in (rows, *cols):
        c = c[order]
        same &= c[1:] == c[:-1]
    return at[order[1:]][same]


def _kept(sig: pa.Array, data: np.ndarray, offs: np.ndarray, gone: np.ndarray, with_text: bool) -> pa.RecordBatch:
    """The rows without the bytes marked ``gone``."""
    base = int(offs[0])
    rise = gone.copy()
    rise[1:] &= ~gone[:-1]
    at = offs[:-1][np.diff(offs) > 0] - base
    rise[at] = gone[at]
    lost, spans = (np.concatenate([[0], np.cumsum(x)])[offs - base] for x in (gone, rise))
    texts = [data[x:y][~gone[x - base:y - base]].tobytes() for x, y in zip(offs[:-1], offs[1:], strict=True)]
    cols = [sig, pa.array(np.diff(lost)), pa.array(np.diff(spans)), pa.array([hashlib.sha256(t).hexdigest() for t in texts])]
    out = ["sig", "n_removed", "n_spans", "kept_sha256"]
    if with_text:
        cols.append(pa.array(texts, pa.binary()))
        out.append("kept")
    return pa.RecordBatch.from_arrays(cols, names=out)


def _spans(column: pa.ListArray, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last of the spans that ``column`` lists for the rows from i to j."""
    part = column.slice(i, j - i)
    row = np.repeat(np.arange(j - i), part.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    flat = part.flatten()
    return row, *(flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))


def _marked(size: int, lo: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Marks of ``size`` positions that lie in one of the ranges from lo to before end."""
    edge = np.bincount(lo, minlength=size + 1) - np.bincount(end, minlength=size + 1)
    return np.cumsum(edge[:size]) > 0


class Found:
    """Runs of several rows: one entry a run, as list columns a row."""

    def __init__(self):
        self.rows: list[np.ndarray] = [np.zeros(0, np.int64)]
        self.cols: list[list[np.ndarray]] = [[np.zeros(0, U.U64)] * 3 + [np.zeros(0, np.int64)] * 2]

    def add(self, row: np.ndarray, start: np.ndarray, r: Runs, at: np.ndarray) -> None:
        """Runs ``r`` of ``row``, which begin at byte ``at`` of a row that begins at ``start``."""
        self.rows.append(row)
        lo = at - start
        self.cols.append([r.short, *r.pairs(), lo, lo + r.hi - r.lo])

    def columns(self, n: int) -> list[pa.ListArray]:
        row, counts = np.concatenate(self.rows), None
        order = np.argsort(row, kind="stable")
        counts = np.bincount(row, minlength=n)
        cols = [np.concatenate(c)[order] for c in zip(*self.cols, strict=True)]
        return [*[_longs(c, counts) for c in cols[:3]], *[U.list_column(c, counts, pa.int64()) for c in cols[3:]]]


LISTS = ["s", "a", "b", "lo", "hi"]


def _first_runs(window: int, short: int):
    """Arrow task: (id, text, live, d) to the runs with a live stand-in, and the spans of
    window starts (from, to) whose string starts earlier in the same text."""
    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(1))
            for i, j in U.chunks(offs, CHUNK):
                cut = offs[i:j + 1]
                base, live = int(cut[0]), np.unique(b.column(2).slice(i, j - i).flatten().to_numpy(zero_copy_only=False)).view(U.U64)
                found, places, ok = Found(), [], every_start(cut, window)
                for x, r in segments(data[base:cut[-1]], ok, window, short):
                    r.keep(np.isin(r.short, live))
                    if len(r.lo):
                        places.append((x, r, np.searchsorted(cut, r.lo + x + base, side="right") - 1, r.twice()))
                again = np.zeros(int(cut[-1]) - base, bool)
                if places:
                    rows, stand, more = (np.concatenate(v) for v in zip(*[(p[2], p[1].short, p[3]) for p in places], strict=True))
                    keys, _, times = _distinct(np.concatenate([rows, rows[more]]), [np.concatenate([stand, stand[more]])], j - i)
                    twice, row, seen, cols = np.unique(keys[1][times > 1]), [], [], []
                    for x, r, at_row, _ in places:
                        own = np.flatnonzero(np.isin(r.short, twice))
                        at, of = r.positions(own)
                        row.append(at_row[of])
                        seen.append(at + x)
                        cols.append(r.full(at))
                    again[_again(np.concatenate(row), [np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate(seen))] = True
                for x, r, row, _ in places:
                    out = again[x:x + SEGMENT]
                    if out.any():  # the first of them stays and stands for all
                        r.split(ok[x:x + SEGMENT] & ~out)
                        r.keep(np.isin(r.short, live))
                        row = np.searchsorted(cut, r.lo + x + base, side="right") - 1
                    found.add(row, cut[row], r, r.lo + x + base)
                edge = np.diff(again.astype(np.int8), prepend=0, append=0)
                lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
                row = np.searchsorted(cut, lo + base, side="right") - 1
                counts = np.bincount(row, minlength=j - i)
                own = [U.list_column(v + base - cut[row], counts, pa.int64()) for v in (lo, hi)]
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in (0, 3)), *found.columns(j - i), *own],
                                                 names=["id", "d", *LISTS, "own_lo", "own_hi"])
    return run


def _next_runs(window: int, length: int):
    """Arrow task: (id, text, open spans of window starts, d) to their runs at the next length.
    Only the bytes of open windows are named."""
    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(1))
            for i, j in U.chunks(offs, CHUNK):
                cut = offs[i:j + 1]
                base, size = int(cut[0]), int(cut[-1] - cut[0])
                row, lo, hi = _spans(b.column(2), i, j)
                lo, hi = lo + cut[row] - base, hi + cut[row] - base
                ok, need = _marked(size, lo, hi + 1), _marked(size, lo, hi + window)
                where, found = np.flatnonzero(need), Found()
                # windows are whole in what is left: their bytes stay side by side
                for x, r in segments(data[base:base + size][need], ok[need], window, length):
                    at = where[r.lo + x] + base
                    of = np.searchsorted(cut, at, side="right") - 1
                    found.add(of, cut[of], r, at)
                yield pa.RecordBatch.from_arrays([*(b.column(k).slice(i, j - i) for k in (0, 3)), *found.columns(j - i)],
                                                 names=["id", "d", *LISTS])
    return run


def _cut(window: int, with_text: bool):
    """Arrow task: (sig, text, gone spans of window starts) to what stays of each text."""
    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(1))
            for i, j in U.chunks(offs, CHUNK):
                cut = offs[i:j + 1]
                row, lo, hi = _spans(b.column(2), i, j)
                at = cut[row] - cut[0]
                gone = _marked(int(cut[-1] - cut[0]), lo + at, hi + at + window)
                yield _kept(b.column(0).slice(i, j - i), data, cut, gone, with_text)
    return run


def lengths(window: int) -> list[int]:
    """Stand-in lengths of the levels: half, three quarters and all of the window."""
    half = (window + 1) // 2
    return sorted({half, (half + window + 1) // 2, window})


def suffix_dedup(spark: SparkSession, docs: DataFrame, window: int = 100, id_col: str = "doc_id",
                 text_col: str = "text", texts: bool = True) -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and, with
    ``texts``, ``kept``: the bytes that stay (null where nothing is removed)."""
    if window < 4:
        raise ValueError("window must be at least 4 bytes")
    s = U.Scratch(spark, "suffixes")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    short = (window + 1) // 2
    longs = "array<bigint>"
    base = s.save(src.mapInArrow(_scan(window, short), f"id bigint, sig binary, n bigint, shorts {longs}, own {longs}"), "base")
    classes = s.save(base.where("id is not null").groupBy("sig").agg(F.min("id").alias("rep")), "classes")
    firsts = base.where(F.size("shorts") > 0).join(classes.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi")
    firsts = s.save(firsts.dropDuplicates(["sig", "id"]).select("id", "shorts", "own"), "firsts")

    # first level: stand-ins in sorted order; what isn't unique stays
    marks = firsts.select(F.explode("shorts").alias("h"), "id")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), src.rdd.getNumPartitions())
    shared = marks.repartitionByRange(parts, "h", "id").sortWithinPartitions("h", "id").mapInArrow(_shared, "h bigint, id bigint")
    live = shared.union(firsts.select(F.explode("own").alias("h"), "id"))
    live = s.save(live.groupBy("id").agg(F.collect_set("h").alias("live")), "live")
    s.drop("firsts")
    found = (src.mapInArrow(_fetch(U.id_filter(live, "id")), "id bigint, sig binary, text string")
             .join(classes.select("sig", F.col("rep").alias("id")), ["sig", "id"], "left_semi").join(live, "id"))
    # an id that several texts use: their positions are kept apart
    found = s.save(found.withColumn("d", F.xxhash64("sig")), "texts")

    # runs at growing lengths; gone: spans of window starts
    lists = ", ".join(f"{c} {longs}" for c in LISTS)
    gone, todo = [], None
    for length in lengths(window):
        if todo is None:
            runs = s.save(found.select("id", "text", "live", "d").mapInArrow(
                _first_runs(window, length), f"id bigint, d bigint, {lists}, own_lo {longs}, own_hi {longs}"), f"runs-{length}")
            own = runs.where(F.size("own_lo") > 0).select("id", "d", F.arrays_zip(
                F.col("own_lo").alias("lo"), F.col("own_hi").alias("hi")).alias("gone"))
            gone.append(s.save(own, "own"))
        else:
            runs = s.save(found.select("id", "d", "text").join(todo, ["id", "d"]).select("id", "text", "open", "d").mapInArrow(
                _next_runs(window, length), f"id bigint, d bigint, {lists}"), f"runs-{length}")
        runs = runs.select("id", "d", F.explode(F.arrays_zip(*LISTS)).alias("r")).select("id", "d", *[f"r.{c}" for c in LISTS])
        ranks = s.save(runs.groupBy("s", "a", "b").agg(F.min("id").alias("first"), F.max("id").alias("last")), f"ranks-{length}")
        per = ranks.groupBy("s").agg((F.min(F.struct("a", "b")) != F.max(F.struct("a", "b"))).alias("several"))
        owners = s.save(ranks.join(per, "s").where("first < last or several").select("a", "b", "first", "several"), f"owners-{length}")
        span = F.struct("lo", "hi")
        state = (runs.select("id", "d", "a", "b", "lo", "hi").join(owners, ["a", "b"]).where("first < id or several").groupBy("id", "d")
                 .agg(F.collect_set(F.when(F.col("first") < F.col("id"), span)).alias("gone"),
                      F.collect_set(F.when(F.col("first") == F.col("id"), span)).alias("open")))
        state = s.save(state, f"states-{length}")
        s.drop(f"runs-{length}", f"ranks-{length}", f"owners-{length}")
        gone.append(state.where(F.size("gone") > 0).select("id", "d", "gone"))
        todo = state.where(F.size("open") > 0).select("id", "d", "open")
        if todo.isEmpty():
            break

    # the bytes that stay, of every text that loses some
    lost = reduce(DataFrame.union, gone).groupBy("id", "d").agg(F.flatten(F.collect_set("gone")).alias("gone"))
    cut = found.select("id", "d", "sig", "text").join(lost, ["id", "d"]).select("sig", "text", "gone").mapInArrow(
        _cut(window, texts), "sig binary, n_removed bigint, n_spans bigint, kept_sha256 string" + (", kept binary" if texts else ""))
    cut = s.save(cut.dropDuplicates(["sig"]), "cut")

    out = base.select("id", "sig", "n").join(classes.join(cut, "sig", "left"), "sig", "left")
    whole = F.col("id").isNotNull() & (F.col("rep") < F.col("id")) & (F.col("n") >= window)
    mine = F.col("id").isNotNull() & (F.col("rep") == F.col("id")) & (F.col("n_removed") > 0)

    def chosen(all_gone, column, else_):
        return F.when(whole, all_gone).when(mine, F.col(column)).otherwise(else_)

    cols = [F.col("id").alias("doc_id"), F.col("n").alias("n_bytes"),
            chosen(F.col("n"), "n_removed", F.lit(0)).cast("long").alias("n_removed"),
            chosen(F.lit(1), "n_spans", F.lit(0)).cast("long").alias("n_spans"),
            chosen(F.lit(EMPTY_SHA), "kept_sha256", F.lower(F.hex("sig"))).alias("kept_sha256")]
    if texts:
        cols.append(chosen(F.lit(b""), "kept", F.lit(None)).alias("kept"))
    return out.select(*cols)
