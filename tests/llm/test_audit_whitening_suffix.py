"""Operators 11 to 13 against brute force."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import filter_audit as A
from quayside.llm import suffix_dedup as S
from quayside.llm import whitening as V


# ------------------------------------------------------------------ filter audit

def audit_by_hand(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    rows = []
    for i, t, part in docs:
        t = t or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
        bad = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
               "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
               "E": i is not None and least[t] < i}
        marks = [x for x in labels if i is not None and x[0] == i]
        rows.append((part or "", {f for f in bad if bad[f]}, any(x[1] == 1 for x in marks), any(x[2] == 1 for x in marks)))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        per = []
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                seen = sum(f in r[1] for r in mine)
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                per.append(("".join(order), step, f, len(left), len(gone), seen - len(gone), sum(r[1] == {f} for r in mine),
                            sum(r[2] for r in gone), sum(r[3] for r in gone)))
        for o, step, f, *rest in per:
            out[part, o, step] = (*rest, shapley[f])
    return out


def audit(spark, docs, labels):
    schema = "doc_id bigint, text string, lang string, digest string, mask string, part string, n string, label string"
    d = spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in docs], schema)
    m = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = A.filter_audit(spark, d.repartition(3) if docs else d, m).collect()
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in A.COUNTS) for r in got}, len(got)


def test_audit_equals_brute_force(spark, corpus):
    rnd = random.Random(1)
    docs = [(i, t, rnd.choice(["en", "de", None, ""])) for i, t in corpus]
    docs += [(9000 + k, "SHOUT LOUD 100 % " * k, "en") for k in range(1, 40)]
    docs += [(9100 + k, " ".join(f"v{j}" for j in range(120)), "fr") for k in range(50)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i, _, _ in docs if rnd.random() < 0.5]
    labels += [(docs[0][0], 1, 1), (docs[0][0], 0, None), (None, 1, 1)]
    want = audit_by_hand(docs, labels)
    got, n = audit(spark, docs, labels)
    assert n == len(want) and got == want


def test_audit_of_an_empty_table(spark):
    assert audit(spark, [], []) == ({}, 0)


def test_carry_save_counts_equal_plain_counts():
    rnd = np.random.default_rng(2)
    words = rnd.integers(0, 1 << 32, 5000, dtype=np.uint32)
    times = np.where(rnd.random(5000) < 0.1, rnd.integers(0, 1 << 40, 5000), 1)
    c = A.Counter()
    for at in range(0, 5000, 700):
        c.add(words[at:at + 700], times[at:at + 700])
    assert c.counts() == [int(times[(words >> np.uint32(s)) & np.uint32(1) == 1].sum()) for s in range(32)]
    assert max(map(sum, [[len(w) for w in p] for p in c.planes])) <= 2


# -------------------------------------------------------------------- whitening

def vectors(n=400, d=12, seed=3):
    rnd = np.random.default_rng(seed)
    return (rnd.normal(size=(n, d)) @ rnd.normal(size=(d, d)) + rnd.normal(size=d)).astype(np.float32).astype(float)


def whitened(spark, rows, most=32):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"d": F.lit("x"), "n": F.lit("x"), "k": F.lit(1)})
    return V.whiten(spark, df.repartition(3) if rows else df, most).collect()


def test_cross_products_are_exact():
    rnd = np.random.default_rng(4)
    for n, d, hi in ((1, 1, 5), (130, 5, 1 << 12), (70, 3, 1 << 40), (64, 4, 1)):
        x = rnd.integers(-hi, hi, (n, d))
        x[:, 0] = 7
        s, q = V.cross_products(x)
        big = x.astype(object)
        assert s == list(big.sum(axis=0)) and (q == big.T.dot(big)).all()


def test_whitening_equals_numpy(spark):
    x = vectors()
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(0, x[0].tolist()), (None, x[1].tolist())]
    bad = [(900, None), (901, [float("nan")] + [0.0] * 11), (902, [None] + [0.0] * 11), (903, [float("inf")] * 12), (904, [])]
    got = whitened(spark, rows + bad, most=5)
    q = np.floor(64 * np.array([r[1] for r in rows], np.float64)).astype(np.int64) + 1_000_000
    n = len(q)
    dev = ((n * q - q.sum(axis=0)) ** 2).sum(axis=1)
    c = q - q.mean(axis=0)
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(got) == 5 * n and {r.n for r in got} == {n}
    assert max(r.identity_error for r in got) < 1e-9
    by = {}
    for r in got:
        by.setdefault((r.vec_id, int(r.deviation)), {})[r.component] = r
    for (i, _), v, y in zip(rows, dev, c @ u / np.sqrt(e), strict=True):
        mine = by[i, int(v)]
        for k in range(5):
            assert math.isclose(abs(mine[k + 1].whitened), abs(y[k]), abs_tol=1e-6)
            assert math.isclose(mine[k + 1].explained, e[k] / e.sum(), rel_tol=1e-9)


def test_whitening_drops_components_without_variance(spark):
    x = vectors(50, 4)
    x[:, 1], x[:, 2] = 3.0, x[:, 0]
    got = whitened(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    assert {r.component for r in got} == {1, 2} and len(got) == 100
    assert math.isclose(sum({r.component: r.explained for r in got}.values()), 1)


def test_whitening_of_few_rows_and_other_lengths(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, [1.0, 2.0])]) == []
    got = whitened(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (3, [5.0]), (4, [7.0]), (5, [7.0])])
    assert sorted((r.vec_id, r.n) for r in got) == [(1, 2), (2, 2), (3, 3), (4, 3), (5, 3)]


# ------------------------------------------------------------------ suffix dedup

def cut_by_hand(rows, window):
    """n_bytes, n_removed, n_spans, kept of every row."""
    texts = [(t or "").encode() for _, t in rows]
    where: dict[bytes, list] = {}
    for (i, _), t in zip(rows, texts, strict=True):
        if i is not None:
            for p in range(len(t) - window + 1):
                where.setdefault(t[p:p + window], []).append((i, t, p))
    least = {w: min(x[0] for x in v) for w, v in where.items()}
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        gone = np.zeros(len(t), bool)
        if i is not None:
            seen = set()
            for p in range(len(t) - window + 1):
                w = t[p:p + window]
                if least[w] < i or w in seen:
                    gone[p:p + window] = True
                seen.add(w)
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((i, len(t), int(gone.sum()), int((gone & ~np.append(False, gone[:-1])).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


def run_cut(spark, rows, frame, window):
    got = S.suffix_dedup(spark, frame(rows), window=window).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str), got


@pytest.mark.parametrize("window", [100, 37, 8])
def test_suffix_dedup_equals_brute_force(spark, corpus, frame, window):
    rows = corpus + [(7000, "ab" * 400), (7001, "xyz" + "ab" * 150 + "q"), (7002, "é" * 300), (7003, None)]
    got, full = run_cut(spark, rows, frame, window)
    want = cut_by_hand(rows, window)
    assert got == sorted((w[:5] for w in want), key=str)
    kept = {(w[0], w[4]): w[5] for w in want}
    assert all(r.kept is None and r.n_removed == 0 or bytes(r.kept) == kept[r.doc_id, r.kept_sha256] for r in full)


def test_suffix_dedup_of_reused_ids_and_mirrored_words(spark, frame):
    a, b = "a", "b"
    for _ in range(10):
        a, b = a + b, b + a
    passage = "".join(chr(97 + k * k % 23) for k in range(130))
    rows = [(1, a + " end"), (2, b + " end"), (3, "one " + passage), (3, passage + " two"), (4, "x" + passage)]
    got, _ = run_cut(spark, rows, frame, 100)
    assert got == sorted((w[:5] for w in cut_by_hand(rows, 100)), key=str)


def test_suffix_dedup_across_segments(spark, frame):
    rnd = random.Random(8)
    long = "".join(rnd.choice("abcdefgh ") for _ in range(1_300_000))
    rows = [(1, long), (2, "start " + long[1_040_000:1_060_000] + " end"), (3, long[:50] + "#" + long[1_048_500:1_048_700] + "#" + long[5:90])]
    got, _ = run_cut(spark, rows, frame, 100)
    found = {r[0]: r[1:4] for r in got}
    assert found[1] == (1_300_000, 0, 0) and found[2] == (20_010, 20_000, 1) and found[3] == (337, 200, 1)


def test_suffix_dedup_of_empty_tables(spark, frame):
    assert run_cut(spark, [], frame, 100)[0] == []
    got, _ = run_cut(spark, [(1, None), (2, ""), (None, None)], frame, 100)
    assert [r[1:4] for r in got] == [(0, 0, 0)] * 3


def test_doubled_names_are_equal_exactly_for_equal_strings():
    data = np.frombuffer(bytes(random.Random(9).choices(b"ab", k=4000)), np.uint8)
    for length in (1, 3, 8, 13, 50):
        f, _ = S.names(data, length)
        by = {}
        for p, x in enumerate(f.tolist()):
            by.setdefault(x, set()).add(data[p:p + length].tobytes())
        assert len(f) == 4001 - length and all(len(v) == 1 for v in by.values())
        assert len(by) == len({data[p:p + length].tobytes() for p in range(len(f))})
