"""Tokenising, packing, archives, search and sharding against brute force and round trips."""

import collections
import io
import os
import random
import zipfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.llm.ann_permutation import nearest, recall
from quayside.llm.feistel_shard import Permutation, feistel_shards, position_of, row_at
from quayside.llm import ann_permutation, packing
from quayside.llm.packing import B, K1, Index, best_links, pack, pack_shard
from quayside.llm.spm_trie import TrieEncoder, decode_ids, encode_texts
from quayside.llm.warc_zip import (INDEX, MEMBER, ZipRanges, package, parse_record, payload_digest, read_packages, record,
                                   records, round_trip, write_packages)
from quayside.llm.word_ids import WordIds, word_ids
from quayside.llm import util as U

CHARS = st.characters(exclude_categories=("Cs",))
TEXT = st.text(st.one_of(st.characters(max_codepoint=0x250), CHARS, st.sampled_from(" \n\t.,'▁<|>éÉß0aA")), max_size=40)


# --- token ids -------------------------------------------------------------------

@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_word_ids_equal_the_tokenizer(text):
    words = word_ids()
    want = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(words.encode(text), words.dtype).tolist() == want


def test_word_ids_of_special_tokens_and_small_cache(monkeypatch):
    import quayside.llm.word_ids as m
    monkeypatch.setattr(m, "KEEP", 3)
    words = WordIds()
    for t in ["a b c d e f a b", "<|endoftext|> x<|startoftext|>", "it's I'LL don't", "ÄÖ ÎĲı İ ŉ", "１２ 日本語"] * 2:
        assert np.frombuffer(words.encode(t), words.dtype).tolist() == words.tokenizer.encode(t, add_special_tokens=False).ids


# --- packing ---------------------------------------------------------------------

def check_pieces(rows, pieces, length):
    """Every id in exactly one piece, windows gapless and full or a power of two."""
    words = word_ids()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_doc[(p.doc_id, p.doc_tokens)].append(p)
        by_seq[p.sequence_id].append(p)
    for seq in by_seq.values():
        seq.sort(key=lambda p: p.offset)
        at = 0
        for p in seq:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at == length or at & (at - 1) == 0 and at <= length
    want = collections.Counter()
    for i, t in rows:
        ids = np.append(np.frombuffer(words.encode(t or ""), words.dtype), 1).astype("<u4")
        want[(i, len(ids), ids.tobytes())] += 1
    got = collections.Counter()
    for (i, n), own in by_doc.items():
        starts = collections.defaultdict(list)
        for p in own:
            assert zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 and len(p.ids) == p.length
            starts[p.start].append(p)
        while starts:  # equal ids and lengths (repeated rows): follow one document after the other
            at, raw = 0, b""
            while at < n:
                p = starts[at].pop()
                if not starts[at]:
                    del starts[at]
                raw += np.array(p.ids, "<u4").tobytes()
                at += p.length
            assert at == n
            got[(i, n, raw)] += 1
    # of two documents with equal id and length the pieces may be told apart only by content
    assert {k[:2]: 0 for k in got} == {k[:2]: 0 for k in want}
    assert sum(got.values()) == sum(want.values())
    plain = {k for k in want if sum(v for q, v in want.items() if q[:2] == k[:2]) == 1}
    assert plain <= set(got)


@pytest.mark.parametrize("length,shard", [(2048, 1 << 20), (64, 1500), (8, 300)])
def test_pack(spark, frame, corpus, length, shard):
    pieces = pack(spark, frame(corpus), length=length, shard_tokens=shard).collect()
    check_pieces(corpus, pieces, length)


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (2, ""), (3, "word")]])
def test_pack_edges(spark, frame, rows):
    check_pieces(rows, pack(spark, frame(rows), length=4).collect(), 4)


def test_neighbours_fill_the_window_best_first():
    lengths = np.array([5, 3, 9, 2])
    free = np.ones(4, bool)
    out = pack_shard(lengths, lambda seed: iter([i for i in (2, 3, 1, 0) if free[i]]), free, 8)
    assert out[:3] == [(0, 0, 5, 0, 0), (2, 0, 3, 0, 5), (2, 3, 6, 1, 0)]
    assert sum(n for _, _, n, _, _ in out) == lengths.sum()


def test_pack_puts_copies_of_a_text_together(spark, frame):
    topics = ["river boat fish net harbour wave sail island", "piano violin concert melody chorus opera tune band",
              "bread oven flour yeast butter sugar cake cream"]
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(topics[i % 3].split(), k=60))) for i in range(30)]
    pieces = pack(spark, frame(rows), length=256).collect()
    mixed = collections.defaultdict(set)
    for p in pieces:
        mixed[p.sequence_id].add(p.doc_id % 3)
    assert sum(len(v) for v in mixed.values()) <= len(mixed) + 6


def brute_bm25(docs, idf, mean, query):
    """Score of every document, id by id."""
    return [sum(idf[t] * d.count(t) * (K1 + 1) / (d.count(t) + K1 * (1 - B + B * len(d) / mean)) for t in set(query) & set(d))
            for d in docs]


def test_every_term_of_a_seed_asks_the_index():
    rnd = random.Random(4)
    docs = [[rnd.randrange(int(rnd.choice([20, 100, 900]))) for _ in range(rnd.randrange(1, 300))] for _ in range(40)]
    df = np.array([sum(t in d for d in docs) for t in range(900)])
    idf, mean = np.log1p((40 - df + 0.5) / (df + 0.5)), sum(map(len, docs)) / 40
    index = Index([np.array(d, "<u2") for d in docs], idf, mean)
    assert max(len(set(d)) for d in docs) > 48 and 0 < len(index.dense) < 900
    for seed in range(40):
        want = brute_bm25(docs, idf, mean, docs[seed])
        assert index.scores(index.terms[seed]) == pytest.approx(want, rel=1e-5)
        assert [round(want[i], 2) for i in index.neighbours(seed)] == sorted((round(x, 2) for x in want), reverse=True)


def test_links_are_the_best_of_the_whole_table(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(packing, "SLICE_ROWS", 13)
    rnd = random.Random(6)
    docs = [[rnd.randrange(int(rnd.choice([20, 100, 900]))) for _ in range(rnd.randrange(1, 200))] for _ in range(40)]
    df = np.array([sum(t in d for d in docs) for t in range(900)])
    idf, mean = np.log1p((40 - df + 0.5) / (df + 0.5)), sum(map(len, docs)) / 40
    texts = spark.createDataFrame([(i, bytearray(np.array(d, "<u2").tobytes())) for i, d in enumerate(docs)], "uid bigint, ids binary")
    got = collections.defaultdict(dict)
    for r in best_links(U.Scratch(spark, "t"), texts, "<u2", idf, mean, sum(map(len, docs))).collect():
        got[r.u][r.v] = r.score
    for i in range(40):
        want = dict(enumerate(brute_bm25(docs, idf, mean, docs[i])))
        del want[i]
        best = sorted((x for x in want.values() if x > 0), reverse=True)[:5]
        assert sorted(got[i].values(), reverse=True) == pytest.approx(best, rel=1e-5)
        assert all(want[v] == pytest.approx(x, rel=1e-5) for v, x in got[i].items())


def test_search_leaves_the_best_links_only(spark, monkeypatch):
    """What a round leaves behind doesn't grow with the number of blocks."""
    monkeypatch.setattr(packing, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(packing, "SLICE_ROWS", 20)
    rnd = random.Random(8)
    docs = [[rnd.randrange(30) for _ in range(40)] for _ in range(50)]
    idf, mean = np.ones(30), 40
    texts = spark.createDataFrame([(i, bytearray(np.array(d, "<u2").tobytes())) for i, d in enumerate(docs)], "uid bigint, ids binary")
    s = U.Scratch(spark, "t")
    links = best_links(s, texts, "<u2", idf, mean, sum(map(len, docs)))
    left = [n for n in os.listdir(s.root.removeprefix("file:")) if spark.read.parquet(s.path(n)).count()]
    assert len(left) == 1 and links.count() == 5 * len(docs) == spark.read.parquet(s.path(left[0])).count()
    best = {i: sorted(brute_bm25(docs[:i] + docs[i + 1:], idf, mean, d))[-5:] for i, d in enumerate(docs)}
    assert sorted((r.u, r.score) for r in links.collect()) == [(i, pytest.approx(x, rel=1e-5)) for i, v in best.items() for x in v]


def test_best_of_a_block_breaks_ties_and_keeps_a_bound():
    index = Index([np.array(x, "<u2") for x in ([1, 2], [2, 1], [3, 4], [1, 2], [1, 9])], np.ones(10), 2)
    ask, none, zero = [np.array([1, 2], "<u2")], np.array([-1]), np.zeros(1)
    (top, score), = index.best(ask, 2, none, zero)
    assert top.tolist() == [0, 1] and score[0] == score[1]
    assert [t.tolist() for t, _ in index.best(ask, 9, np.array([0]), zero)] == [[1, 3, 4]]
    assert [t.tolist() for t, _ in index.best(ask, 9, none, score[:1])] == [[0, 1, 3]]


def test_best_neighbours_share_a_shard(spark, frame):
    rnd = random.Random(7)
    rows = []
    for i in range(120):  # two texts of a pair share 12 words of their own and differ in 30
        own = random.Random(i // 2)
        words = ["".join(own.choices("abcdefghij", k=7)) for _ in range(12)] + ["".join(rnd.choices("klmnopqrst", k=7)) for _ in range(30)]
        rows.append((i, " ".join(rnd.sample(words, 42))))
    pieces = pack(spark, frame(rows), length=64, shard_tokens=2500).collect()
    check_pieces(rows, pieces, 64)
    shard = {p.doc_id: p.sequence_id >> 32 for p in pieces}
    assert len(set(shard.values())) > 3
    assert sum(shard[i] == shard[i + 1] for i in range(0, 120, 2)) >= 61 - len(set(shard.values()))


# --- SentencePiece ---------------------------------------------------------------

ENC = TrieEncoder()


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT.filter(lambda t: "\x00" not in t), max_size=4))
def test_trie_equals_the_library(texts):
    got = [np.frombuffer(x, np.int32).tolist() for x in ENC.encode(texts)]
    assert got == ENC.sp.encode(texts)
    for t, ids in zip(texts, got, strict=True):
        if "▁" not in t:
            assert ENC.decode(np.array(ids, np.int32).tobytes()) == t == ENC.sp.decode(ids)


def test_unigram_states_are_the_best_segmentation():
    enc = TrieEncoder(kind="unigram")
    rng = np.random.default_rng(1)
    words = ["▁" + "".join(rng.choice(list("thesandior"), rng.integers(1, 9))) for _ in range(60)]

    def best(w):
        table = [0.0]
        for i in range(1, len(w) + 1):
            table.append(max([table[i - 1] + enc.low] + [table[i - n] + enc.scores[w[i - n:i]]
                                                         for n in range(1, i + 1) if w[i - n:i] in enc.scores]))
        return table[-1]

    for w, pieces in enc.walk(set(words)):
        assert "".join(reversed(pieces)) == w
        assert sum(enc.scores.get(p, enc.low) for p in pieces) == pytest.approx(best(w))


def test_encode_texts(spark, frame, corpus):
    out = encode_texts(frame(corpus))
    got = out.collect()
    want = collections.Counter((i, tuple(ENC.sp.encode(t or ""))) for i, t in corpus)
    assert collections.Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert all(r.round_trip and r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<i4").tobytes()) for r in got)
    back = decode_ids(out).collect()
    assert collections.Counter((r.doc_id, r.text) for r in back) == collections.Counter((i, t or "") for i, t in corpus)
    assert encode_texts(frame([])).count() == 0


# --- archives --------------------------------------------------------------------

def test_zip_ranges_read_plain_and_zip64():
    parts = [record(i, 1, f"http://h/{i}", b"x" * i * 50, False, None) for i in range(5)]
    parts.append(record(9, 1, None, b"x" * 50, True, 1))
    lines, at = [], 0
    for i, p in enumerate(parts):
        lines.append(f'{{"offset": {at}, "length": {len(p)}, "page": {i}, "url": null}}\n')
        at += len(p)
    wide = package(parts, lines, zip64=True)
    raw = package(parts, lines)
    with zipfile.ZipFile(io.BytesIO(raw), "a") as z:
        z.comment = b"a comment with PK\x05\x06 inside"
        raw = z.fp
        raw.seek(0)
    raw = raw.getvalue() if raw is not None else b""
    many = io.BytesIO()  # more members than 16 bits count: a ZIP64 end record
    with zipfile.ZipFile(many, "w") as z:
        z.writestr(MEMBER, b"".join(parts))
        z.writestr(INDEX, "".join(lines))
        for i in range(65_600):
            z.writestr(f"f{i}", b"")
    for data in (package(parts, lines), wide, raw, many.getvalue()):
        if not data:
            continue
        reads = []

        def read(off, n, data=data, reads=reads):
            reads.append(n)
            return data[off:off + n]

        z = ZipRanges(read, len(data))
        got = list(records(z, read_bytes=60))
        assert [len(p) for _, _, p in got] == [0, 50, 100, 150, 200, 0]
        assert got[-1][1]["WARC-Type"] == "revisit" and got[-1][1]["WARC-Refers-To"] == "<urn:x-page:1:1>"
        assert all(h["WARC-Payload-Digest"][5:] == payload_digest(p) for _, h, p in got[:-1])
    with pytest.raises(ValueError, match="end of central"):
        ZipRanges(lambda o, n: b"\0" * n, 100)
    squeezed = io.BytesIO()
    with zipfile.ZipFile(squeezed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(MEMBER, b"".join(parts))
        z.writestr(INDEX, "".join(lines))
    data = squeezed.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        list(records(ZipRanges(lambda o, n: data[o:o + n], len(data))))


def test_record_payload_may_hold_anything():
    payload = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\né".encode()
    head, back = parse_record(record(3, 1, "http://x/ü ü\n", payload, False, None))
    assert back == payload and head["WARC-Target-URI"] == "http://x/%C3%BC%20%C3%BC%0A"


PAGES = "page_id bigint, url string, html string, extra string, sha string, twin string"


@pytest.mark.parametrize("least", [0, 10])
def test_warc_round_trip(spark, least):
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(["<p>a</p> long enough", "<p>é</p>", None, "", "<p>a</p> long enough"])]
    rows += [(50 - i, None, "hot " * 9) for i in range(20)] + [(7, "u", "x"), (7, "u", "x"), (None, None, "hot " * 9), (None, "v", None)]
    rows += [(100, "w", "long " * 100_000)]
    df = spark.createDataFrame([(*r, "e", "e", "e") for r in rows], PAGES).repartition(3)
    got = collections.Counter(tuple(r) for r in round_trip(spark, df, package_bytes=500, least_bytes=least).collect())
    groups = collections.defaultdict(list)
    for i, _, h in rows:
        groups[(h or "").encode()].append(i)
    want = collections.Counter()
    for p, ids in groups.items():
        known = sorted((i for i in ids if i is not None)) + [i for i in ids if i is None]
        for k, i in enumerate(known):
            again = k > 0 and len(p) >= least
            want[(i, len(p), payload_digest(p), "revisit" if again else "response", known[0] if again else None)] += 1
    assert got == want


def test_warc_payloads_come_back(spark):
    df = spark.createDataFrame([(1, "u", "<b>1</b>"), (2, "v", "<b>1</b>"), (3, "w", "ü")], "page_id bigint, url string, html string")
    back = {r.page_id: r for r in read_packages(write_packages(spark, df, U.Scratch(spark, "t"))).collect()}
    assert bytes(back[1].payload) == b"<b>1</b>" and back[2].payload is None and back[2].refers_to == 1
    assert bytes(back[3].payload).decode() == "ü" and back[3].url == "w"
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert round_trip(spark, empty).count() == 0


# --- nearest neighbours ------------------------------------------------------------

VECS = "vec_id bigint, embedding array<float>, uid string, vec string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], VECS).repartition(3)


def test_nearest_small_sets_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i * 5, rng.normal(size=8).astype("f4").tolist()) for i in range(40)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # copies: ties go to the smaller id
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] + [1.0] * 7), (303, [1.0] * 7 + [None]), (304, []),
             (305, [1.0, 2.0]), (None, [1.0] * 8), (320, [float("inf")] * 8), rows[2]]
    got = nearest(spark, vectors(spark, rows), k=20).collect()
    ok = dict((i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8
              and None not in v and np.isfinite(v).all() and any(v))
    for q in [i for i in ok if i % 20 == 0]:
        want = sorted(((-float((ok[q] * v).sum()), i) for i, v in ok.items() if i != q))[:20]
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [r.vec_id for r in mine] == [i for _, i in want]
        assert [r.score for r in mine] == pytest.approx([-s for s, _ in want])
    assert {r.query_id for r in got} == {i for i in ok if i % 20 == 0}


@pytest.mark.parametrize("rows,n", [([], 0), ([(20, None)], 0), ([(20, [1.0, 0.0])], 0), ([(20, [1.0, 0.0]), (3, [0.0, 1.0])], 1)])
def test_nearest_edges(spark, rows, n):
    assert nearest(spark, vectors(spark, rows)).count() == n


def test_every_dimension_has_its_own_index(spark):
    rng = np.random.default_rng(9)
    rows = [(0, [1.0, 2.0])] + [(i, rng.normal(size=8).astype("f4").tolist()) for i in range(1, 61)]
    rows += [(100 + i, rng.normal(size=3).astype("f4").tolist()) for i in range(1, 41)]
    rows += [(140, [1.0, 0.0]), (141, [0.0, 1.0]), (142, [0.0, 1.0]), (200, [5.0])]
    got = {}
    for r in sorted(nearest(spark, vectors(spark, rows), k=20).collect()):
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    want = {}
    for q, x in rows:
        found = sorted((-float(np.dot(x, v)), i) for i, v in rows if i != q and len(v) == len(x)) if q % 20 == 0 else []
        if found:
            want[q] = [(i, round(-s, 9)) for s, i in found[:20]]
    assert got == want and 200 not in got and len(got[0]) == 3 and len(got[20]) == 20


def test_recall_and_norms(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(3000, 32)) * rng.uniform(0.2, 3, (3000, 1))  # the inner product is not the angle here
    v = vectors(spark, [(i, r.astype("f4").tolist()) for i, r in enumerate(x)])
    assert recall(nearest(spark, v), v) >= 0.9


def test_recall_where_the_share_applies(spark):
    n = 5000
    share, least = ann_permutation.SHARE, ann_permutation.LEAST_BLOCKS
    assert share * n / least > 2 * 20 + 1  # no block's floor of 2k + 1 rows exceeds the share
    x = np.random.default_rng(8).normal(size=(n, 64))
    v = vectors(spark, [(i, r.astype("f4").tolist()) for i, r in enumerate(x)])
    found = recall(nearest(spark, v), v)
    print("recall", found)
    assert found >= 0.9


# --- sharding ----------------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 16, 17, 100, 257, 1000, 4097])
def test_permutation_is_a_bijection(n):
    for seed in (1, 2, 99):
        perm = Permutation(n, seed)
        a, b = perm.sides
        assert a * b >= n and a * b - n <= a + b
        got = [perm.position(i) for i in range(n)]
        assert sorted(got) == list(range(n))
    if n > 50:
        assert got != list(range(n)) and Permutation(n, 1).position(3) is not None


@pytest.mark.parametrize("n", [1, 2, 5, 17, 999])
def test_positions_and_inverse_in_spark(spark, n):
    perm = Permutation(n, 7)
    df = spark.range(n).withColumn("p", position_of(F.col("id"), perm))
    rows = df.withColumn("back", row_at(df["p"], perm)).collect()
    assert [r.p for r in sorted(rows)] == [perm.position(i) for i in range(n)]
    assert all(r.back == r.id for r in rows)


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_feistel_shards(spark, frame, corpus, shards):
    got = feistel_shards(spark, frame(corpus), shards=shards).collect()
    text = [(t or "").encode() for _, t in corpus]
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == \
        collections.Counter((i, len(x) + 1, zlib.crc32(x)) for (i, _), x in zip(corpus, text, strict=True))
    assert sorted(r.row_number for r in got) == list(range(len(corpus)))
    order = sorted(got, key=lambda r: r.row_number)
    assert [(-1 if r.doc_id is None else r.doc_id) for r in order] == sorted(-1 if i is None else i for i, _ in corpus)
    slots = collections.defaultdict(list)
    perm = Permutation(len(corpus), 1)
    for r in got:
        assert r.position == perm.position(r.row_number)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    again = feistel_shards(spark, frame(corpus).repartition(1), shards=shards).collect()
    assert collections.Counter(map(tuple, again)) == collections.Counter(map(tuple, got))


def test_feistel_edges(spark, frame):
    assert feistel_shards(spark, frame([])).count() == 0
    assert [tuple(r) for r in feistel_shards(spark, frame([(None, None)])).collect()] == [(None, 1, 0, 0, 0, 0, 0)]
