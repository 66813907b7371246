"""Quality: a generalised additive model with pairwise interactions.

A text becomes a few plain measures (length, letter case, symbols, repetition,
lines). Each measure is cut into quantile bins and owns a look-up table of
additions to the log-odds; chosen pairs of measures own small two-way tables.
The tables are learnt by cyclic boosting: round after round, each measure in
turn gets one shallow tree fitted on the gradients summed by its bins, and the
tree's leaves are added into its table. Pairs are then chosen by how much a
shallow two-way tree gains on what is left, and boosted in the same way.

Scoring is bin look-ups and additions, vectorised over a batch; every text is
read whole, in one scan without a shuffle. Learning uses a bounded, documented
sample of labelled rows (``max_rows``, those with the smallest id hashes).

Defined results: null, empty and wordless texts are scored by their zero
measures; rows with a null id are scored but never learnt from; with labels of
one kind only (or none) every score is the smoothed share of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.llm.toxicity import held_out, labelled_texts, learning_rows, logistic

#: Labelled rows to learn from, at most.
MAX_ROWS = 20_000
BINS, PAIR_BINS = 32, 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE = 0.08

MEASURES = ("log_words", "word_bytes", "upper_share", "symbol_share", "bars_per_word", "marks_share",
            "echo_share", "distinct_share", "top_word_share", "short_word_share", "stops_per_word",
            "commas_per_word", "digit_share", "lines_per_word", "other_bytes_share", "repeated_line_share")


def _classes() -> np.ndarray:
    """One bit per byte class: upper, lower, symbol, bar, mark, stop, comma, digit, newline, other."""
    table = np.zeros(256, np.int64)
    table[65:91] |= 1
    table[97:123] |= 2
    for c in b"#$%&*+=@^~<>/\\[]{}_":
        table[c] |= 4
    table[ord("|")] |= 8
    table[[ord("!"), ord("?")]] |= 16
    table[ord(".")] |= 32
    table[ord(",")] |= 64
    table[48:58] |= 128
    table[10] |= 256
    table[128:] |= 512
    return table


CLASSES = _classes()


def measures(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Rows by ``MEASURES`` for the texts of a batch."""
    lo, hi = int(offs[0]), int(offs[-1])
    part = CLASSES[data[lo:hi]]
    at = offs - lo

    def count(flags: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[at]).astype(float)

    upper, lower, symbol, bar, mark, stop, comma, digit, line, other = (count((part >> k) & 1) for k in range(10))
    starts, ends, rows = U.word_spans(data, offs)
    h, _ = U.word_hashes(data, offs)
    n = np.diff(rows).astype(float)
    size = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=size[1:])
    short = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts <= 3, out=short[1:])
    same = np.zeros(len(starts) + 1, np.int64)
    if len(h):
        np.cumsum(np.concatenate([[False], h[1:] == h[:-1]]), out=same[1:])
    newline = np.zeros(256, bool)
    newline[10] = True
    lh, lrows = U.word_hashes(data, offs, sep=newline)
    echo, distinct, top, lines = (np.zeros(len(n)) for _ in range(4))
    for r in range(len(n)):
        a, b = int(rows[r]), int(rows[r + 1])
        if b > a:
            _, c = np.unique(h[a:b], return_counts=True)
            distinct[r], top[r] = len(c), c.max()
            echo[r] = same[b] - same[a + 1]
            own = lh[lrows[r]:lrows[r + 1]]
            lines[r] = 1 - len(np.unique(own)) / max(len(own), 1)
    total, words = np.maximum(np.diff(offs), 1), np.maximum(n, 1)
    return np.stack([np.log1p(n), np.diff(size[rows]) / words, upper / np.maximum(upper + lower, 1), symbol / total,
                     bar / words, mark / total, echo / words, distinct / words, top / words, np.diff(short[rows]) / words,
                     stop / words, comma / words, digit / total, line / words, other / total, lines], axis=1)


def _leaves(g: np.ndarray, h: np.ndarray, depth: int = 2, least: float = 4.0) -> np.ndarray:
    """Additions per bin of a shallow tree on gradient and curvature sums."""
    out = np.zeros(len(g))

    def grow(a: int, b: int, left: int) -> None:
        cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
        if left and b - a > 1:
            gain = cg[:-1] ** 2 / (ch[:-1] + 1) + (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + 1)
            gain[(ch[:-1] < least) | (ch[-1] - ch[:-1] < least)] = -1
            k = int(np.argmax(gain))
            if gain[k] > cg[-1] ** 2 / (ch[-1] + 1):
                grow(a, a + k + 1, left - 1)
                grow(a + k + 1, b, left - 1)
                return
        out[a:b] = -cg[-1] / (ch[-1] + 1)

    grow(0, len(g), depth)
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Additions of the best tree that cuts one way, then each half the other way."""
    best, table = -1.0, np.zeros(g.shape)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        cg, ch = a.cumsum(0).cumsum(1), b.cumsum(0).cumsum(1)
        for i in range(a.shape[0] - 1):
            parts, gain = [], 0.0
            for top, bg, bh in ((True, cg[i], ch[i]), (False, cg[-1] - cg[i], ch[-1] - ch[i])):
                s = bg[:-1] ** 2 / (bh[:-1] + 1) + (bg[-1] - bg[:-1]) ** 2 / (bh[-1] - bh[:-1] + 1)
                j = int(np.argmax(s))
                gain += s[j]
                parts.append((top, j, -bg[j] / (bh[j] + 1), -(bg[-1] - bg[j]) / (bh[-1] - bh[j] + 1)))
            if gain > best:
                best, t = gain, np.zeros(a.shape)
                for top, j, x, y in parts:
                    rows = slice(0, i + 1) if top else slice(i + 1, None)
                    t[rows, :j + 1], t[rows, j + 1:] = x, y
                table = t.T if turned else t
    return table, best


@dataclass
class AdditiveModel:
    """Cut points and tables of the measures and of the chosen pairs."""
    bias: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for j, (cut, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            z += table[np.searchsorted(cut, x[:, j], side="right")]
        if self.pairs:
            small = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.pair_cuts)]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                z += table[small[i], small[j]]
        return logistic(z)

    def score_texts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for i, j in U.chunks(offs):
            out.append(self.scores(measures(data, offs[i:j + 1])))
        return np.concatenate(out)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> AdditiveModel:
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        bias = float(np.log(share / (1 - share)))

        def cut(bins: int) -> list[np.ndarray]:
            if not len(x):
                return [np.zeros(0)] * len(MEASURES)
            q = np.linspace(0, 1, bins + 1)[1:-1]
            return [np.unique(np.quantile(x[:, j], q)) for j in range(x.shape[1])]

        cuts, small = cut(BINS), cut(PAIR_BINS)
        model = cls(bias, cuts, [np.zeros(len(c) + 1) for c in cuts], small)
        if not 0 < y.sum() < len(y):
            return model
        bins = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
        z = np.full(len(y), bias)
        for _ in range(ROUNDS):
            for j, b in enumerate(bins):
                p = logistic(z)
                step = RATE * _leaves(np.bincount(b, p - y, minlength=len(cuts[j]) + 1),
                                      np.bincount(b, p * (1 - p), minlength=len(cuts[j]) + 1))
                model.tables[j] += step
                z += step[b]
        coarse = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(small)]

        def two_way(i: int, j: int):
            p = logistic(z)
            wide, shape = len(small[j]) + 1, (len(small[i]) + 1, len(small[j]) + 1)
            cell = coarse[i] * wide + coarse[j]
            g = np.bincount(cell, p - y, minlength=shape[0] * wide).reshape(shape)
            h = np.bincount(cell, p * (1 - p), minlength=shape[0] * wide).reshape(shape)
            return _quarters(g, h) if min(shape) > 1 else (np.zeros(shape), -1.0)

        gains = sorted(((two_way(i, j)[1], i, j) for i in range(len(small)) for j in range(i)), reverse=True)
        model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
        model.pair_tables = [np.zeros((len(small[i]) + 1, len(small[j]) + 1)) for i, j in model.pairs]
        for _ in range(PAIR_ROUNDS):
            for k, (i, j) in enumerate(model.pairs):
                step = RATE * two_way(i, j)[0]
                model.pair_tables[k] += step
                z += step[coarse[i], coarse[j]]
        return model


def _measure(batches):
    """Arrow task: (label, id, text) to (label, id, measures)."""
    for b in batches:
        data, offs = U.text_buffers(b.column(2))
        for i, j in U.chunks(offs):
            x = measures(data, offs[i:j + 1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i),
                 U.list_column(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())], names=["label", "id", "x"])


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, label: str = "quality",
                id_col: str = "doc_id", text_col: str = "text") -> AdditiveModel:
    """Fit on the labelled documents outside the held-out fold."""
    got = labelled_texts(docs, learning_rows(labels, label, max_rows), id_col, text_col, _measure,
                         "label int, id bigint, x array<double>").toPandas()
    x = np.stack([np.asarray(v, float) for v in got["x"]]) if len(got) else np.zeros((0, len(MEASURES)))
    y = got["label"].to_numpy(dtype=float)
    order = np.lexsort((*x.T, got["id"].to_numpy(dtype=np.int64)))
    return AdditiveModel.fit(x[order], y[order])


def score_quality(docs: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score`` (likelihood of good quality)."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.score_texts(*U.text_buffers(b.column(2))))],
                                             names=["doc_id", "held_out", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, held_out boolean, score double")

