"""Driver queries of the operators, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.llm import centroids, licenses, mixing
from tidemark.llm.balanced_packing import pack_balanced
from tidemark.llm.conversations import repair
from tidemark.llm.language_id import identify
from tidemark.llm.ngram_join import near_copies
from tidemark.llm.packing import pack_documents
from tidemark.llm.pii import summarize
from tidemark.llm.prefix_tokens import count_tokens
from tidemark.llm.quality_rules import judge
from tidemark.llm.secret_scan import scan_in_two
from tidemark.llm.topk import top_k


def op1_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_in_two(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(table(spark, sf_dir, "documents"))


#: Target weights in whole hundredths: the first source and four others get more.
MIX_UNITS = {"src0": 20} | {f"src{i}": 8 if i < 5 else 3 for i in range(1, 20)} | {"other": 3}
BLOCK_CHARS = 20_000


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_UNITS, BLOCK_CHARS)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=40, rounds=5, dim=64)


def op13_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_balanced(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096)


TOP_K_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, x.vec_id, CAST(list_sum(list_transform(list_zip(q.v, x.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v q JOIN v x ON x.row <> q.row WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("op") and callable(f)}
ORACLE = {"op2_pfair_mixing": mixing.oracle(MIX_UNITS, BLOCK_CHARS), "op5_license_scan": licenses.oracle(), "op4_exact_top_k": TOP_K_SQL, "op12_centroid_clustering": centroids.oracle()}
