"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, personal data, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read as the next one's ``docs``.
All but the last return the columns of documents. Decisions come back by a hash of doc_id and text, so rows whose doc_id is null or
shared by other texts are decided each for itself. Rows: a document whose text is null or empty passes every stage (once, as below); repeated rows
of one doc_id (or none) and text leave the second stage once; empty tables give no rows.
Every stage sets the session to small batches (``common.SMALL_BATCHES``), where it has no such settings: a stage's result is computed later, when
it is written, so they stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm import byte_bpe, importance, near_duplicates, pii, templates
from tessella.llm.common import KEYS, cut, fresh, in_small_batches, keyed, table

#: Per cent of common shingles from which the near-duplicate stage links two documents; op7 has a threshold of its own.
SIMILAR = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the importance sample stay, and those without text, which have no quality; rows are judged where they lie, without a join."""
    in_small_batches(spark)
    decided = importance.sampled(docs, table(spark, sf_dir, "labels"))
    return decided.where(F.col(decided.columns[-1])["kept"] | (F.coalesce("text", F.lit("")) == "")).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each near-duplicate component stays, once; one without a doc_id if none has one."""
    in_small_batches(spark)
    decided = near_duplicates.near_duplicates(docs, SIMILAR, *KEYS)
    stays = keyed(docs).join(decided.where("kept").select(*KEYS).distinct(), [*KEYS], "left_semi")
    copy = fresh(stays, "copy")
    number = F.row_number().over(Window.partitionBy(*KEYS, F.col("text").isNull()).orderBy(*KEYS))
    return stays.withColumn(copy, number).where(F.col(copy) == 1).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    in_small_batches(spark)
    found = cut(templates.leaking(docs, table(spark, sf_dir, "benchmark")).select(*KEYS), "leaks")
    return keyed(docs).join(found, [*KEYS], "left_anti").select(*docs.columns)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to pseudonyms; n_chars follows the text."""
    pii.with_key(in_small_batches(spark))
    out = pii.pseudonymise(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("bigint"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the bytes decoded from them; with little memory, as the executors are full by now."""
    in_small_batches(spark)
    return byte_bpe.round_trip(docs, with_bytes=False, kept=80_000, together=500_000).select("doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", drop_leaks),
    ("PII", replace_private),
    ("byte-level BPE encoding and decoding", encode),
]

#: SQL can't express the sample, the minima, the templates, the networks and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage's result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, "stage")
    return docs
