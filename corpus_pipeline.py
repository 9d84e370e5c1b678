"""A training-corpus pipeline of five operators over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all
but the last return the columns of ``docs``. ``run`` writes every stage as Parquet in
the shared folder and reads it again for the next one.

Null and empty texts: the first stage drops texts without a letter, so later stages
only see them when called alone; there they are kept, as each operator says. Columns of
``docs`` beside its own are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, table
from tidemark.llm.language_id import fit_documents, recognized
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.ngram_join import near_copies
from tidemark.llm.packing import pack_documents
from tidemark.llm.queries import BLOCK_CHARS, MIX_UNITS
from tidemark.llm.secret_scan import redact


#: Consecutive parts of the mixed order that are packed by themselves, at most.
RANGES = 16


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops rows whose language isn't recognized: text null or without a letter, or no language likelier than a guess.

    The others stay, whatever their ids and however often they are there. Without
    labelled rows every text with a letter stays; no rows give no rows.
    """
    return recognized(docs, fit_documents(docs))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, that with the smallest id; one without an id only where none has one.

    Rows are told apart by a key written with them, so copies that share an id are copies
    too. Texts without words have no copies and all stay; no rows give no rows.
    """
    keyed = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "keyed")
    groups = near_copies(keyed.select(F.col("__row").alias("doc_id"), "text")).select(F.col("doc_id").alias("__row"), "component_id")
    id_ = F.col("doc_id").cast("long")
    order = F.struct(id_.isNull().alias("none"), id_.alias("id"), F.xxhash64(*docs.columns).alias("hash"), F.col("__row").alias("row"))
    ranked = keyed.select("__row", order.alias("order")).join(groups, "__row")
    keep = ranked.groupBy("component_id").agg(F.min("order").alias("first")).select(F.col("first.row").alias("__row"))
    return keyed.join(keep, "__row", "left_semi").select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows the text. No row goes, repeated ones included; no rows give no rows."""
    clean = redact(docs)
    if "n_chars" not in docs.columns:
        return clean
    kind = docs.schema["n_chars"].dataType
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars"))).select(*docs.columns)


def pfair_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents in the order of the target weights. No row goes, repeated ones included; no rows give no rows."""
    return mixed_documents(docs, MIX_UNITS, BLOCK_CHARS)


def _in_order(docs: DataFrame) -> DataFrame:
    """Adds ``__range``: consecutive files of a written table, at most ``RANGES``; 0 where ``docs`` isn't one."""
    names = sorted({path.rpartition("/")[2] for path in docs.inputFiles()})
    try:
        named = docs.withColumn("__file", F.col("_metadata.file_name"))
        named.schema  # noqa: B018
    except AnalysisException:
        names = []
    if not names:
        return docs.withColumn("__range", F.lit(0))
    n = min(RANGES, len(names))
    ranges = docs.sparkSession.createDataFrame([(name, i * n // len(names)) for i, name in enumerate(names)], "__file string, __range int")
    return named.join(F.broadcast(ranges), "__file")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 2048: one row a piece.

    The files of ``docs`` are in mixed order; consecutive ones are packed together and
    sequences are numbered in that order, so the target weights hold along the sequences.
    Repeated rows give their pieces each; a null text is the end id alone; no rows give no rows.
    """
    packed = pack_documents(_in_order(docs), public_tokenizers.path("word_bpe_49k.json"), capacity=2048, by="__range")
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scan", secret_scan),
    ("pfair_mixing", pfair_mixing),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language labels, link components and token ids are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
