"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame.

Each applies its operator, with production parameters, to the whole table and
derives the contract's columns from the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import util as U
from quayside.llm.ann_permutation import nearest
from quayside.llm.exact_dedup import exact_dedup
from quayside.llm.feistel_shard import feistel_shards
from quayside.llm.filter_audit import filter_audit
from quayside.llm.jaccard_join import jaccard_components
from quayside.llm.oracle import ORACLE_SQL as _SQL
from quayside.llm.packing import pack
from quayside.llm.quality import fit_quality, score_quality
from quayside.llm.spm_trie import encode_texts
from quayside.llm.substring_dedup import substring_dedup
from quayside.llm.suffix_dedup import suffix_dedup
from quayside.llm.toxicity import fit_toxicity, score_toxicity
from quayside.llm.warc_zip import round_trip
from quayside.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    U.reach_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_toxicity(spark, docs, _table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = fit_quality(docs, _table(spark, sf_dir, "labels"))
    return score_quality(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, _table(spark, sf_dir, "documents"), length=2048, end_id=1, with_ids=False)


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(spark, _table(spark, sf_dir, "pages"), least_bytes=0)


def op5_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, _table(spark, sf_dir, "embeddings"), k=20, every=20)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(_table(spark, sf_dir, "documents"))


def op7_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feistel_shards(spark, _table(spark, sf_dir, "documents"), shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_components(spark, _table(spark, sf_dir, "documents"), k=4, num=85, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, _table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(spark, _table(spark, sf_dir, "documents"), window=50, texts=False)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten(spark, _table(spark, sf_dir, "embeddings"), most=32)
    return rows.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, _table(spark, sf_dir, "documents"), window=100, texts=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_warc_zip": op4_warc_zip,
    "op5_permutation_index": op5_permutation_index,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_feistel_shards": op7_feistel_shards,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_whitening": op12_whitening,
    "op13_suffix_dedup": op13_suffix_dedup,
}

ORACLE_SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
