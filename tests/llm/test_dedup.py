"""Exact, near and substring deduplication against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.llm.components import components, merged
from quayside.llm.exact_dedup import FuseFilter, exact_dedup
from quayside.llm.jaccard_join import jaccard_components
from quayside.llm.substring_dedup import lengths, sliding_min, substring_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(t, lower=False):
    return WORD.findall((t or "").translate(LOW) if lower else (t or ""))


def test_word_and_window_hashes_follow_the_words():
    texts = ["a b  a", "", "b a\nb a", " Straße \t x", "a"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    h, rows = U.word_hashes(np.frombuffer(b"".join(raw), np.uint8), offs)
    flat = [w for t in texts for w in WORD.findall(t)]
    assert [WORD.findall(t) for t in texts] == [flat[a:b] for a, b in zip(rows, rows[1:], strict=False)]
    same = {}
    for w, x in zip(flat, h.tolist(), strict=True):
        assert same.setdefault(w, x) == x
    assert len(set(same.values())) == len(same)
    g = U.window_hashes(h, 2).tolist()
    pairs = {}
    for p, x in zip(zip(flat, flat[1:], strict=False), g, strict=True):
        assert pairs.setdefault(p, x) == x


def test_sliding_min():
    x = np.random.default_rng(1).integers(0, 50, 40).astype(np.uint64)
    for w in (1, 2, 3, 5, 8, 26, 40, 41):
        assert sliding_min(x, w).tolist() == [min(x[i:i + w]) for i in range(len(x) - w + 1)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 1000, 50_000])
def test_fuse_filter(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2 ** 63, n).astype(np.uint64)
    f = FuseFilter.from_bytes(FuseFilter.build(np.concatenate([keys, keys[:5]])).to_bytes())
    assert f.holds(keys).all()
    others = rng.integers(2 ** 63, 2 ** 64 - 1, 20_000, dtype=np.uint64)
    assert f.holds(others).mean() < (0.006 if n else 0.02)
    if n >= 50_000:
        assert len(f.cells) / n < 1.35


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", t or "")].append(i)
    return groups


@pytest.mark.parametrize("batches", [1, 2, 3])
def test_exact_dedup(spark, frame, corpus, batches):
    got = exact_dedup(spark, frame(corpus), batches=batches).collect()
    groups = brute_exact(corpus)
    want = collections.Counter()
    for norm, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


@pytest.mark.parametrize("batches", [1, 3])
def test_exact_dedup_of_repeated_and_idless_rows(spark, frame, batches):
    """One row of each text stays, however often a row or an empty id repeats."""
    rows = [(None, "x")] * 50 + [(None, "y")] * 30 + [(9, "y")] * 4 + [(3, "y"), (3, "y"), (8, "z"), (8, "z"), (8, "w"), (7, "z ")]
    got = exact_dedup(spark, frame(rows), batches=batches).collect()
    kept = collections.Counter((r.doc_id, r.text_sha256) for r in got if r.kept)
    want = [(None, "x"), (3, "y"), (8, "z"), (7, "z "), (8, "w")]
    assert len(got) == len(rows) and kept == {(i, hashlib.sha256(t.encode()).hexdigest()): 1 for i, t in want}


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (2, "")]])
def test_exact_dedup_edges(spark, frame, rows):
    got = exact_dedup(spark, frame(rows)).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == min(len(rows), 1)


def shingles(t, k):
    w = words(t, lower=True)
    return frozenset(tuple(w[p:p + k]) for p in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(rows, k, num, den):
    sets = [(i, shingles(t, k)) for i, t in rows]
    up = {i: i for i, _ in sets if i is not None}

    def top(a):
        while up[a] != a:
            a = up[a]
        return a

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and den * len(a & b) >= num * len(a | b):
                p, q = top(i), top(j)
                up[max(p, q)] = min(p, q)
    return sorted(((i if i is not None else -1, len(s), top(i) if i is not None else None) for i, s in sets), key=str)


@pytest.mark.parametrize("k,num,den", [(5, 4, 5), (4, 85, 100), (3, 1, 1), (2, 3, 10)])
def test_jaccard_components(spark, frame, corpus, k, num, den):
    got = jaccard_components(spark, frame(corpus), k, num, den).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in got), key=str) == \
        brute_components(corpus, k, num, den)


def test_jaccard_large_group_and_chain(spark, frame):
    """Copies and near copies by the hundred, and a chain whose ends don't link directly."""
    rnd = random.Random(1)
    base = [f"v{i}" for i in range(100)]
    rows = [(i, " ".join(base)) for i in range(200)]
    for i in range(200, 400):
        t = list(base)
        t[rnd.randrange(100)] = f"z{i}"
        rows.append((i, " ".join(t)))
    chain = [f"c{i}" for i in range(60)]
    rows += [(1000 - i, " ".join(chain[i:i + 40])) for i in range(0, 20, 2)]
    got = jaccard_components(spark, frame(rows), 5, 4, 5).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, 5, 4, 5)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, ""), (2, None), (3, "a"), (4, "A")]])
def test_jaccard_edges(spark, frame, rows):
    got = jaccard_components(spark, frame(rows)).collect()
    assert sorted(((r.doc_id if r.doc_id is not None else -1, r.n_shingles, r.component_id) for r in got), key=str) == \
        brute_components(rows, 5, 4, 5)


def test_components_join_when_edges_are_added(spark):
    rnd = random.Random(3)
    old = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(60)]
    new = [(rnd.randrange(160), rnd.randrange(160)) for _ in range(25)]
    s = U.Scratch(spark, "t")
    frames = [spark.createDataFrame(x, "u bigint, v bigint") for x in (old, new)]
    got = merged(components(frames[0], s, "old"), frames[1], s, "new").collect()
    want = components(frames[0].union(frames[1]), s, "all").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_small_tables_are_few_files(spark, monkeypatch):
    """A task that writes a file starts processes, so 300 of them for a few rows cost time and memory."""
    monkeypatch.setattr(U, "FILES", 3)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", U.SHUFFLE_CLEANUP)
    before = {k: spark.conf.get(k, None) for k in names}
    s = U.Scratch(spark, "t", {names[0]: "40", names[1]: "false"})
    path = spark.range(30).selectExpr("id + 1 as u", "id as v")
    components(path, s, "cc")
    assert {k: spark.conf.get(k, None) for k in names} == before
    rounds = [spark.read.parquet(s.path(f"cc-{i}")) for i in (1, 2)]
    assert all(r.count() and len(r.inputFiles()) <= 3 for r in rounds)


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 3), (300, 300)]
    random.Random(2).shuffle(edges)
    out = components(spark.createDataFrame(edges, "u bigint, v bigint"), U.Scratch(spark, "t"))
    got = {r.node: r.component for r in out.collect()}
    assert got == {**dict.fromkeys(range(51), 0), 100: 100, 150: 100, 200: 100}


def brute_substring(rows, n):
    first = {}
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - n + 1):
            key = tuple(w[p:p + n])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if i is not None and first[tuple(w[p:p + n])] < i:
                gone[p:p + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if sum(gone) else None)] += 1
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_substring_dedup(spark, frame, corpus, n):
    got = substring_dedup(spark, frame(corpus), window=n).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_substring(corpus, n)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(2, "a a a a"), (1, "a a"), (3, "")]])
def test_substring_edges(spark, frame, rows):
    got = substring_dedup(spark, frame(rows), window=2).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_substring(rows, 2)


def test_substring_levels_double():
    for n in range(1, 300):
        got = lengths(n)
        assert got[-1] == n and got == sorted(set(got)) and all(b <= 2 * a for a, b in zip(got, got[1:], strict=False))


def test_substring_passages_that_end_at_some_level(spark, frame):
    """Shared runs that stop repeating before, at and after each level's length."""
    rows, i = [], 0
    for n in (5, 12, 13, 14, 24, 25, 26, 37, 49, 50, 51, 99, 101):
        for _ in range(3):
            own = [f"x{i}_{k}" for k in range(60)]
            rows.append((i, " ".join([*own[:25], *(f"s{n}_{k}" for k in range(n)), *own[25:]])))
            i += 1
    got = substring_dedup(spark, frame(rows), window=50).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute_substring(rows, 50)
    assert {r.n_removed for r in got} == {0, 50, 51, 99, 101}
    none = substring_dedup(spark, frame(rows[::3]), window=50).collect()  # nothing survives the first level
    assert {r.n_removed for r in none} == {0} and len(none) == 13


def test_id_filter_has_no_false_negatives(spark):
    ids = spark.range(0, 3000, 7)
    f = U.id_filter(ids, "id")
    x = np.arange(3000)
    hit = U.might_hold(f, x)
    assert hit[::7].all() and hit.mean() < 0.2
    assert spark.range(5).select(F.col("id")).count() == 5
