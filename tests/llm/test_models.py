"""Classifiers: held-out accuracy on the driver's labels, and defined results at the edges."""

import collections
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest

from quayside.llm import toxicity as X
from quayside.llm.quality import MEASURES, AdditiveModel, fit_quality, measures, score_quality
from quayside.llm.toxicity import FactorizationMachine, filter_toxic, fit_toxicity, hashed_terms, score_toxicity

SF = "/root/testdata/sf0.1"


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = y == 1
    return (rank[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


@pytest.mark.parametrize("label,least_auc,least_recall,most_false,cut", [("toxic", 0.95, 0.8, 0.01, 0.5), ("quality", 0.99, 0.98, 0.08, 0.3)])
def test_held_out_accuracy(spark, label, least_auc, least_recall, most_false, cut):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    if label == "toxic":
        out = score_toxicity(docs, fit_toxicity(spark, docs, labels))
    else:
        out = score_quality(docs, fit_quality(docs, labels))
    pdf = out.join(labels, "doc_id").toPandas()
    assert (pdf["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in pdf["doc_id"]]).all()
    pdf = pdf[pdf["held_out"]]
    y, s = pdf[label].to_numpy(), pdf["score"].to_numpy()
    assert ((s >= 0) & (s <= 1)).all()
    assert auc(s, y) >= least_auc
    assert (s[y == 1] >= cut).mean() >= least_recall
    assert (s[y == 0] >= cut).mean() <= most_false
    assert out.count() == docs.count()


def texts(rows):
    raw = [t.encode() for t in rows]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_pairs_are_learnt_that_no_sum_of_weights_expresses(monkeypatch):
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        filler = " ".join(f"f{k}" for k in rng.integers(0, 6, 5))
        rows.append(f"{'insult' if a else 'praise'} {'group' if b else 'thing'} {filler}")
        y.append(int(a == b))  # exclusive or: each word alone says nothing
    row, slot, count, words = hashed_terms(*texts(rows))
    model = FactorizationMachine.fit(row, slot, count, words, np.array(y, float), epochs=40, rate=0.3)
    score = model.scores(row, slot, count, words)
    assert ((score >= 0.5) == np.array(y)).mean() > 0.97


def brute_margin(model, text):
    """Terms one by one, then every weight and every pair of terms in a double loop."""
    found = []
    for word in re.findall(rb"[a-z0-9\x80-\xff]+", text.lower().encode()):
        for stem in (None, 4, 5, 6, 7, 8):
            if stem is None or len(word) > stem:
                _, slot, _, _ = hashed_terms(np.frombuffer(word, np.uint8), np.array([0, len(word)]))
                # the word's own slot, or the one that a text of only that stem adds
                found.append(own_slot(word, stem))
                assert found[-1] in slot
    count = collections.Counter(found)
    x = {t: (1 + math.log(c)) * float(model.idf[t]) for t, c in count.items()}
    norm = math.sqrt(math.sqrt(sum(v * v for v in x.values()))) or 1.0
    x = {t: X.SCALE * v / norm for t, v in x.items()}
    words = len(re.findall(rb"[a-z0-9\x80-\xff]+", text.lower().encode()))
    x[(1 << X.BITS) + min(int(math.log2(words + 1)), X.LENGTHS - 1)] = X.SCALE
    z = model.bias + sum(float(model.weights[t]) * v for t, v in x.items())
    terms = list(x)
    for a in range(len(terms)):
        for b in range(a):
            i, j = terms[a], terms[b]
            z += sum(float(p) * float(q) for p, q in zip(model.factors[i], model.factors[j])) * x[i] * x[j]
    return z


def own_slot(word, stem):
    """Slot of a word, or of its beginning: the one that longer beginnings don't have."""
    def slots(w):
        return set(hashed_terms(np.frombuffer(w, np.uint8), np.array([0, len(w)]))[1].tolist())
    if stem is None:
        return next(iter(slots(word) - {own_slot(word, k) for k in (4, 5, 6, 7, 8) if len(word) > k}))
    short = word[:stem] + b"0"  # its only longest beginning is the stem
    other = word[:stem] + b"1"
    shared = slots(short) & slots(other)
    return next(iter(shared - {own_slot(word, k) for k in (4, 5, 6, 7, 8) if k < stem}))


def test_scores_are_the_sum_over_terms_and_pairs():
    rng = np.random.default_rng(3)
    vocabulary = ["abc", "abcdefghij", "insult", "group9", "über", "stemming", "stemmed", "x"]
    rows = [" ".join(rng.choice(vocabulary, rng.integers(0, 12))) + rng.choice(["", "!", "\n\n"]) for _ in range(60)]
    y = np.array(["insult" in t and "group9" in t for t in rows], float)
    model = FactorizationMachine.fit(*hashed_terms(*texts(rows)), y)
    assert np.abs(model.factors).max() > 0 and (model.weights != 0).any()
    some = [*rows[:12], "", "never seen words"]
    want = [brute_margin(model, t) for t in some]
    assert model.raw(*hashed_terms(*texts(some))) == pytest.approx(want, abs=1e-4)
    assert model.score_texts(*texts(some)) == pytest.approx([1 / (1 + math.exp(-(model.slope * z + model.shift))) for z in want], abs=1e-3)


def test_no_term_is_dropped():
    rows = [f"rare{k:05d} common words" for k in range(7000)]
    model = FactorizationMachine.fit(*hashed_terms(*texts(rows)), np.arange(7000) % 2.0, epochs=1)
    assert (model.idf > 0).sum() > 5500  # every seen slot has its value, however rare


def test_calibration_fits_shares():
    rng = np.random.default_rng(5)
    z = rng.normal(0, 3, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * z - 1)))).astype(float)
    assert X.calibration(z, y) == pytest.approx((0.5, -1), abs=0.15)
    assert X.calibration(z, 1 - y)[0] == 1.0 and X.calibration(z[:3], np.ones(3)) == (1.0, 0.0)
    slope, shift = X.calibration(np.array([-1.0, -2, 1, 2]), np.array([0.0, 0, 1, 1]))  # separable
    assert slope > 0 and np.isfinite([slope, shift]).all()


def test_quality_scores_are_table_look_ups():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (800, len(MEASURES)))
    model = AdditiveModel.fit(x, ((x[:, 0] > 0) ^ (x[:, 1] > 0.2)).astype(float))
    assert model.pairs

    def place(cuts, v):
        return sum(c <= v for c in cuts)

    for r in x[:25]:
        z = model.bias + sum(model.tables[j][place(model.cuts[j], r[j])] for j in range(len(MEASURES)))
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            z += table[place(model.pair_cuts[i], r[i]), place(model.pair_cuts[j], r[j])]
        assert model.scores(r[None])[0] == pytest.approx(1 / (1 + math.exp(-z)), rel=1e-9)


def test_a_repeated_id_is_learnt_from_once(spark):
    docs = spark.range(3000).selectExpr("7L as doc_id", "concat('text ', id) as text").unionByName(
        spark.createDataFrame([(8, None), (8, "b"), (9, None)], "doc_id bigint, text string"))
    rows = spark.createDataFrame([(7, 1), (8, 0), (9, 1)], "id bigint, label int")
    got = X.labelled_texts(docs, rows, "doc_id", "text", lambda b: b, "label int, id bigint, text string").collect()
    again = X.labelled_texts(docs.repartition(7), rows, "doc_id", "text", lambda b: b, "label int, id bigint, text string").collect()
    assert sorted((r.id, r.label) for r in got) == [(7, 1), (8, 0), (9, 1)]
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_terms_are_words_and_stems():
    row, slot, count, words = hashed_terms(*texts(["Abcdefg abcdefg, x", "", "abcde"]))
    assert words.tolist() == [3, 0, 1]
    assert count[row == 0].tolist() and sorted(count[row == 0].tolist()) == [1, 2, 2, 2, 2]  # x; the word and stems of 4, 5, 6
    assert set(slot[row == 2]) & set(slot[row == 0])  # the shared stem of four bytes


def test_measures():
    x = measures(*texts(["", "A b b b.\nA b", "### $$$ | |", "é é"]))
    m = {name: x[:, i] for i, name in enumerate(MEASURES)}
    assert x.shape == (4, len(MEASURES)) and np.isfinite(x).all()
    assert m["log_words"].tolist() == pytest.approx(np.log1p([0, 6, 4, 2]).tolist())
    assert m["echo_share"][1] == pytest.approx(1 / 6) and m["echo_share"][3] == 0.5
    assert m["distinct_share"].tolist() == pytest.approx([0, 3 / 6, 3 / 4, 0.5])
    assert m["bars_per_word"][2] == 0.5 and m["symbol_share"][2] > 0.5 and m["upper_share"][1] == pytest.approx(2 / 6)


def test_additive_model_learns_shapes_and_pairs():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (4000, len(MEASURES)))
    y = ((x[:, 0] ** 2 > 0.3) * 1.0 + (x[:, 1] * x[:, 2] > 0) + rng.normal(0, 0.3, 4000) > 1).astype(float)
    model = AdditiveModel.fit(x[:3000], y[:3000])
    assert (1, 2) in model.pairs or (2, 1) in model.pairs
    assert auc(model.scores(x[3000:]), y[3000:]) > 0.8


DOCS = "doc_id bigint, text string, score string, held_out string, label string"


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(i, 0) for i in range(9)]])
def test_edges(spark, labels):
    rows = [(i, t, "a", "b", "c") for i, t in enumerate(["x y", None, "", "\n", "word " * 30_000])] + [(None, "x", "a", "b", "c"), (0, "x y", "a", "b", "c")]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame([(i, v, v) for i, v in labels] + [(None, 1, 1), (3, None, None)], "doc_id bigint, toxic int, quality int")
    for frame in (docs, docs.limit(0)):
        for out in (score_toxicity(frame, fit_toxicity(spark, frame, lab)), score_quality(frame, fit_quality(frame, lab))):
            got = out.collect()
            assert len(got) == frame.count() and all(0 <= r.score <= 1 for r in got)
    model = fit_toxicity(spark, docs, lab)
    kept = filter_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score < 0.5 for r in score_toxicity(docs, model).collect())


def test_fit_needs_few_bytes_a_term():
    """Beside the table of slots, learning takes a few bytes for each term of the sample."""
    n, each = 20_000, 400
    rng = np.random.default_rng(1)
    slot, count = rng.integers(0, 1 << X.BITS, n * each, dtype=np.int32), np.ones(n * each, np.int32)
    row, words = np.repeat(np.arange(n, dtype=np.int32), each), np.full(n, each)
    labels = (np.arange(n) % 2).astype(np.float64)
    tracemalloc.start()
    model = FactorizationMachine.fit(row, slot, count, words, labels, epochs=0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 14 * n * each
    part = slice(0, 3 * each)
    assert np.array_equal(model.idf, X.inverse_frequencies(slot, n))
    assert len(model.scores(row[part], slot[part], count[part], words[:3])) == 3
