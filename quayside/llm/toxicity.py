"""Toxicity: a factorization machine over hashed terms.

Terms of a document are its lower-cased words (runs of letters, digits and
non-ASCII bytes) and their beginnings of 4 to 8 bytes, hashed into a fixed
table, with ``1 + log(count)`` as value, and one term for the order of
magnitude of its length. The machine scores

    bias + sum of w_i x_i + sum over term pairs of <v_i, v_j> x_i x_j

so it learns pairs (an insult with the mention of a group, a stem in a short
text) that no sum of single weights expresses. The pair sum costs one pass:
half of ``|sum v x|**2 - sum |v x|**2``.

A term's value is ``(1 + log(count)) * idf``, divided by the square root of the
text's norm, so long texts don't outweigh short ones. Every slot of the table has its
own weight and factors: no term is picked by its label alone, since a pair can
matter whose parts say nothing. A slot that no learning row holds has an idf of zero.

Learning uses a bounded, documented sample of labelled rows (``max_rows``, those
with the smallest id hashes) in one task, by mini-batch AdaGrad that touches only the
slots of a batch. A fifth of the sample is kept back to calibrate the margin to a
probability. Every text is then scored whole, in one scan without a shuffle.

Defined results: null, empty and wordless texts get the score of no terms; rows
with a null id are scored but never learnt from; of several texts of one id the one
with the smallest hash is learnt from; with labels of one kind only (or
none) every score is the smoothed share of label 1.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U

#: Labelled rows to learn from, at most.
MAX_ROWS = 20_000
BITS = 18
STEMS = (4, 5, 6, 7, 8)
LENGTHS = 24
FACTORS = 8
#: Factor of all values.
SCALE = 0.55
#: Bytes of text that a task hands back at a time.
OUT_BYTES = 1 << 22
#: Terms of the learning rows that are worked on at a time.
PART = 1 << 20
# Separators of terms: every ASCII byte that is no letter or digit.
TERM_SEP = np.zeros(256, bool)
TERM_SEP[:128] = True
for _lo, _hi in ((48, 58), (65, 91), (97, 123)):
    TERM_SEP[_lo:_hi] = False


def hashed_terms(data: np.ndarray, offs: np.ndarray):
    """Row, slot and count of every distinct hashed term, sorted by row, and the
    number of words per row."""
    starts, ends, rows = U.word_spans(data, offs, TERM_SEP)
    lo, hi = int(offs[0]), int(offs[-1])
    pw, inv = U.powers(U.BASE_A, hi - lo + 1)
    acc = np.empty(hi - lo + 1, U.U64)
    acc[0] = 0
    vals = U.LOWER[data[lo:hi]].astype(U.U64)
    vals += U.U64(1)
    vals *= pw[:hi - lo]
    np.cumsum(vals, out=acc[1:])
    at, size = starts - lo, ends - starts
    words = np.diff(rows)
    owner = np.repeat(np.arange(len(words)), words)
    found = []
    for stem in (0, *STEMS):
        some = np.flatnonzero(size > stem)
        end = ends[some] - lo if stem == 0 else at[some] + stem
        h = (acc[end] - acc[at[some]]) * inv[at[some]]
        slot = (U.mix(h + U.U64(stem)) >> U.U64(64 - BITS)).astype(np.int64)
        found.append(owner[some] << BITS | slot)
    key, count = np.unique(np.concatenate(found), return_counts=True)
    return key >> BITS, key & ((1 << BITS) - 1), count, words


def inverse_frequencies(slot: np.ndarray, rows: int) -> np.ndarray:
    """Of every slot of the table, from one entry per row that holds it."""
    df = np.zeros(1 << BITS, np.int64)
    for at in range(0, len(slot), PART):
        df += np.bincount(slot[at:at + PART], minlength=1 << BITS)
    return np.where(df > 0, np.log((rows + 1.0) / np.maximum(df, 1)), 0).astype(np.float32)


def values(idf: np.ndarray, slot: np.ndarray, count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Values of the terms of rows that start at ``first`` (the last entry is the end)."""
    x = (1 + np.log(count, dtype=np.float32)) * idf[slot]
    lens = np.diff(first)
    norm = np.bincount(np.repeat(np.arange(len(lens)), lens), x * x, minlength=len(lens)) ** 0.25
    return (SCALE * x / np.repeat(np.where(norm > 0, norm, 1), lens)).astype(np.float32)


def length_slot(words: np.ndarray) -> np.ndarray:
    return (1 << BITS) + np.minimum(np.log2(words + 1.0), LENGTHS - 1).astype(np.int64)


@dataclass
class FactorizationMachine:
    """``weights`` and ``factors`` of every slot of the table; the last ``LENGTHS`` rows
    stand for the length of a text. ``slope`` and ``shift`` make the margin a probability."""
    idf: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, first: np.ndarray, term: np.ndarray, value: np.ndarray):
        """Margins of the rows that start at ``first``, and the parts that the gradient needs."""
        if not len(first):
            return np.zeros(0), None, None
        v = self.factors[term] * value[:, None]
        total = np.add.reduceat(v, first, axis=0)
        square = np.add.reduceat((v * v).sum(axis=1), first)
        line = np.add.reduceat(self.weights[term] * value, first)
        return self.bias + line + 0.5 * ((total * total).sum(axis=1) - square), total, v

    def raw(self, row: np.ndarray, slot: np.ndarray, count: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Margin of every row."""
        first = np.searchsorted(row, np.arange(len(words) + 1))
        return self.margins(*with_length(first, slot, values(self.idf, slot, count, first), words))[0]

    def scores(self, row, slot, count, words) -> np.ndarray:
        return logistic(self.slope * self.raw(row, slot, count, words).astype(np.float64) + self.shift)

    def score_texts(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        out = [np.zeros(0)]
        for i, j in U.chunks(offs):
            out.append(self.scores(*hashed_terms(data, offs[i:j + 1])))
        return np.concatenate(out)

    @classmethod
    def fit(cls, row, slot, count, words, labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.1,
            decay: float = 1e-3, seed: int = 7) -> FactorizationMachine:
        """AdaGrad on the log loss over mini-batches of four fifths of the rows, then
        calibration on the others."""
        size, n = (1 << BITS) + LENGTHS, len(labels)
        share = (labels.sum() + 0.5) / (n + 1.0)
        idf = inverse_frequencies(slot, n)
        model = cls(idf, float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32))
        if not 0 < labels.sum() < n:
            return model
        rng = np.random.default_rng(seed)
        first = np.searchsorted(row, np.arange(n + 1, dtype=row.dtype))
        value = np.empty(len(slot), np.float32)
        for i, j in U.chunks(first, PART):
            a, b = first[i], first[j]
            value[a:b] = values(idf, slot[a:b], count[a:b], first[i:j + 1] - a)
        rows = rng.permutation(n)
        kept_back, learnt = rows[:n // 5], rows[n // 5:]
        model.factors = rng.normal(0, 0.02, (size, FACTORS)).astype(np.float32)
        gw, gv, gb = np.full(size, 1e-2, np.float32), np.full((size, FACTORS), 1e-2, np.float32), 1e-2

        def part(pick: np.ndarray):
            lens = first[pick + 1] - first[pick]
            begin = np.append(0, np.cumsum(lens))
            at = np.repeat(first[pick] - begin[:-1], lens) + np.arange(begin[-1])
            return with_length(begin, slot[at], value[at], words[pick])

        for _ in range(epochs):
            rng.shuffle(learnt)
            for k in range(0, len(learnt), batch):
                pick = learnt[k:k + batch]
                begin, t, x = part(pick)
                z, total, v = model.margins(begin, t, x)
                err = ((logistic(z) - labels[pick]) / len(pick)).astype(np.float32)
                owner = np.repeat(np.arange(len(pick)), np.diff(np.append(begin, len(t))))
                pull = err[owner] * x
                u, at = np.unique(t, return_inverse=True)
                pair = pull[:, None] * (total[owner] - v)
                g1 = np.bincount(at, pull).astype(np.float32) + decay * model.weights[u]
                g2 = np.stack([np.bincount(at, pair[:, f]) for f in range(FACTORS)], axis=1).astype(np.float32)
                g2 += decay * model.factors[u]
                gw[u] += g1 * g1
                gv[u] += g2 * g2
                gb += float(err.sum()) ** 2
                model.weights[u] -= rate * g1 / np.sqrt(gw[u])
                model.factors[u] -= 0.3 * rate * g2 / np.sqrt(gv[u])
                model.bias -= 0.1 * rate * float(err.sum()) / gb ** 0.5
        margin = [model.margins(*part(kept_back[k:k + 1024]))[0] for k in range(0, len(kept_back), 1024)]
        model.slope, model.shift = calibration(np.concatenate([np.zeros(0), *margin]), labels[kept_back])
        return model


def with_length(first: np.ndarray, slot: np.ndarray, value: np.ndarray, words: np.ndarray):
    """The rows' terms with the length term before each row's others."""
    n = len(words)
    begin = first[:-1] + np.arange(n)
    term, x = np.empty(len(slot) + n, np.int64), np.full(len(slot) + n, SCALE, np.float32)
    other = np.ones(len(term), bool)
    other[begin] = False
    term[begin], term[other], x[other] = length_slot(words), slot, value
    return begin, term, x


def calibration(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits the labels best (targets a little
    inside 0 and 1); 1 and 0 without both labels or where the margin doesn't rise with them."""
    pos = labels.sum()
    if not 0 < pos < len(labels):
        return 1.0, 0.0
    spread = float(margin.std()) or 1.0
    x = np.stack([margin / spread, np.ones(len(margin))])
    want = np.where(labels == 1, (pos + 1) / (pos + 2), 1 / (len(labels) - pos + 2))
    w = np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = w @ x
        return float((np.logaddexp(0, z) - want * z).sum() + 1e-3 * (w @ w))

    for _ in range(50):
        p = logistic(w @ x)
        step = np.linalg.solve((x * (p * (1 - p))) @ x.T + 2e-3 * np.eye(2), x @ (p - want) + 2e-3 * w)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
    return (float(w[0] / spread), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learning_rows(labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """(id, label) of at most ``max_rows`` labelled rows outside the held-out fold: those with
    the smallest id hashes, whatever the layout. Conflicting labels of an id: the larger."""
    named = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    return (named.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col(label)).cast("int").alias("label"))
            .orderBy(F.xxhash64("id"), "id").limit(max_rows))


def labelled_texts(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, features: Callable, schema: str) -> DataFrame:
    """Features of the learning rows' texts (columns label, id, text in). The row
    set is bounded, so it is broadcast; of several texts of one id the one with the
    smallest hash counts, picked before the shuffle, so a hot id stays one row."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    one = src.join(F.broadcast(rows), "id").groupBy("label", "id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    return one.select("label", "id", "text").mapInArrow(features, schema)


def _terms(batches):
    """Arrow task: (label, id, text) to (label, id, words, slots, counts)."""
    for b in batches:
        data, offs = U.text_buffers(b.column(2))
        for i, j in U.chunks(offs):
            row, slot, count, words = hashed_terms(data, offs[i:j + 1])
            lens = np.bincount(row, minlength=j - i)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(words),
                 U.list_column(slot.astype(np.int32), lens, pa.int32()), U.list_column(count.astype(np.int32), lens, pa.int32())],
                names=["label", "id", "words", "slots", "counts"])


def fit_toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
                 label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> FactorizationMachine:
    """Fit on the labelled documents outside the held-out fold: at most ``max_rows``
    rows, in one task, which returns the model."""
    s = U.Scratch(spark, "toxicity")
    sample = s.save(labelled_texts(docs, learning_rows(labels, label, max_rows), id_col, text_col, _terms,
                                   "label int, id bigint, words bigint, slots array<int>, counts array<int>"), "sample")
    fitted = sample.coalesce(1).mapInArrow(_fit, "model binary").collect()
    s.drop("sample")
    return pickle.loads(fitted[0].model) if fitted else FactorizationMachine.fit(*[np.zeros(0, np.int64)] * 4, np.zeros(0))


def _fit(batches):
    """Arrow task: all learning rows, ordered by id, to the model."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    label, ids, words = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in range(3))
    slot, count = (np.concatenate([b.column(i).flatten().to_numpy() for b in parts]) for i in (3, 4))
    lens = np.concatenate([b.column(3).value_lengths().to_numpy() for b in parts]).astype(np.int64)
    del parts
    pa.default_memory_pool().release_unused()  # the copies above are all that is used
    order = np.argsort(ids, kind="stable")
    ends = np.cumsum(lens)
    spans = [slice(ends[i] - lens[i], ends[i]) for i in order]
    slot = np.concatenate([slot[x] for x in spans])
    count = np.concatenate([count[x] for x in spans])
    lens, words, label = lens[order], words[order], label[order].astype(np.float64)
    model = FactorizationMachine.fit(np.repeat(np.arange(len(lens), dtype=np.int32), lens), slot, count, words, label)
    yield pa.RecordBatch.from_arrays([U.blob_column([pickle.dumps(model)])], names=["model"])


def score_toxicity(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, score``."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.score_texts(*U.text_buffers(b.column(2))))],
                                             names=["doc_id", "held_out", "score"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def filter_toxic(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.5,
                 text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            data, offs = U.text_buffers(b.column(at))
            for i, j in U.chunks(offs, OUT_BYTES):
                yield b.slice(i, j - i).filter(pa.array(model.score_texts(data, offs[i:j + 1]) < threshold))
        pa.default_memory_pool().release_unused()  # the worker waits for other stages

    return docs.mapInArrow(run, docs.schema)
