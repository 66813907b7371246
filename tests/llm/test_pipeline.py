"""The pipeline against brute force, stage by stage, and the registered queries' columns."""

import collections

import duckdb
import pytest
from pyspark.sql import functions as F
from test_dedup import brute_components, brute_exact, brute_substring
from test_texts import check_pieces

import __spark_entry__ as E
import corpus_pipeline as P
from quayside.llm.filter_audit import COUNTS
from quayside.llm.toxicity import fit_toxicity, score_toxicity

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def labels_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame([(i, 0, 1) for i in range(3)], "doc_id bigint, toxic int, quality int").write.parquet(f"{d}/labels.parquet")
    return d


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, frame, corpus, labels_dir):
    own = ("_id", "_sha", "_n", "_nth", "_kept", "_sig", "_words", "_twin", "gone_sha", "twin_sha", "key", "_id_")
    docs = frame(corpus).withColumns({"n_chars": F.col("doc_id"), **{c: F.lit("x") for c in own}})
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "substring_dedup", "packing"]

    out = P.toxicity(spark, docs, labels_dir)
    assert out.columns == docs.columns
    score = score_toxicity(docs, fit_toxicity(spark, docs, spark.read.parquet(f"{labels_dir}/labels.parquet")))
    assert out.count() == score.where("score < 0.5").count()

    out = P.exact(spark, docs, labels_dir)
    assert out.columns == docs.columns
    want = brute_exact(corpus)
    keep = {k: min((i for i in v if i is not None), default=None) for k, v in want.items()}
    got = rows_of(out)
    assert collections.Counter(i for i, _ in got) == collections.Counter(keep.values())
    assert set(brute_exact(got)) == set(want)

    out = P.near(spark, docs, labels_dir)
    assert out.columns == docs.columns
    comp = {i: c for i, _, c in brute_components(corpus, 5, 4, 5) if i != -1}
    assert collections.Counter(rows_of(out)) == collections.Counter((i, t) for i, t in corpus if i is None or comp[i] == i)

    out = P.passages(spark, docs, labels_dir)
    assert out.columns == docs.columns
    want = collections.Counter()
    text = {}
    for i, t in corpus:
        text[i] = t
    for (i, _, gone, _, kept), n in brute_substring(corpus, 50).items():
        if i is not None:
            want[(i, kept if gone else text[i])] += n
    assert collections.Counter(r for r in rows_of(out) if r[0] is not None) == want
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.doc_id is not None and r.text != text[r.doc_id])

    check_pieces(corpus, P.packing(spark, docs, labels_dir).collect(), 2048)


def test_an_id_with_two_texts(spark, frame, labels_dir):
    a, b, c = (" ".join(f"{x}{i}" for i in range(120)) for x in "abc")
    rows = [(1, a), (5, a + " z"), (5, b), (6, c), (6, b + " z"), (7, None), (7, a + " y")]
    assert sorted(rows_of(P.near(spark, frame(rows), labels_dir)), key=str) == sorted([(1, a), (5, b), (6, c), (7, None)], key=str)
    rows = [(1, a), (5, "new " + a), (5, b), (6, "x " + b + " y"), (6, c)]
    got = rows_of(P.passages(spark, frame(rows), labels_dir))
    assert sorted(got) == sorted([(1, a), (5, "new"), (5, b), (6, "x y"), (6, c)])


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, None), (1, None), (2, "")]])
def test_stages_on_edges(spark, frame, labels_dir, rows):
    for _, stage in P.STAGES:
        out = stage(spark, frame(rows), labels_dir)
        assert out.count() <= max(len(rows), 1)


def test_run_applies_the_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs
    for _, stage in P.STAGES[:-1]:
        rows = stage(spark, rows, SF)
    check_pieces(rows_of(rows), P.run(spark, SF).collect(), 2048)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.LLM_SQL))
def test_queries_match_their_sql(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)

    def key(df):
        return collections.Counter(tuple(None if v is None or v != v else v for v in r) for r in df[cols].itertuples(index=False))

    assert key(got) == key(want)


CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op4_warc_zip": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
    "op5_permutation_index": ["query_id", "rank", "vec_id", "score"],
    "op6_sentencepiece": ["doc_id", "ids", "n_ids"],
    "op7_feistel_shards": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op8_jaccard_join": ["doc_id", "n_shingles", "component_id"],
    "op9_exact_dedup": ["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
    "op10_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op11_filter_audit": ["part", "filter_order", "step", *COUNTS],
    "op12_whitening": ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    "op13_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
}


def test_every_operator_has_a_query():
    assert set(CONTRACT) | {"pipeline"} == set(E.LLM_QUERIES)


@pytest.mark.parametrize("name", [n for n in CONTRACT if n not in E.LLM_SQL])
def test_contract_columns(spark, name):
    out = E.queries()[name](spark, SF)
    assert out.columns[:len(CONTRACT[name])] == CONTRACT[name]
    table = {"op4_warc_zip": "pages", "op5_permutation_index": "embeddings", "op12_whitening": "embeddings"}.get(name, "documents")
    n = spark.read.parquet(f"{SF}/{table}.parquet").count()
    if name == "op5_permutation_index":
        assert out.count() == -(-n // 20) * 20
    elif name == "op12_whitening":
        assert out.count() == 32 * n
    elif name != "op3_packing":
        assert out.count() == n
