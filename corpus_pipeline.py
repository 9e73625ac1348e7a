"""Corpus pipeline: from raw documents to packed training sequences.

Each stage works on all that the one before kept and calls one operator of the package:

1. language ID: documents without a recognisable language (``und``) go.
2. n-gram Jaccard join: of each component of similar texts the smallest id stays.
3. benchmark decontamination: documents that hold a benchmark window go.
4. secret scans: secrets are replaced in the text, ``n_chars`` follows; no document goes.
5. best-fit packing: the rest becomes pieces of sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import decontamination, language_id, ngram_jaccard, packing, secrets
from adtally.llm.queries import BYTE_VOCABULARY, LEAK_WORDS, SEQUENCE_TOKENS, vocabulary
from adtally.llm.store import table, written


def recognise_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text has a language; the model learns from the documents outside the held-out fold."""
    known = docs.where(F.col("doc_id").isNotNull() & ~language_id.held_out_fold("doc_id"))
    model = language_id.fit(known, "doc_id", "text", "lang")
    found = language_id.identify(docs, model, keep=docs.columns)
    return found.where(F.col("lang_pred") != language_id.UNKNOWN).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one_each(docs).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a word in a benchmark window."""
    found = decontamination.find_leaks(docs, table(spark, sf_dir, "benchmark"), LEAK_WORDS)
    leaks = found.where("contaminated").select(F.col("key").alias("_key")).distinct()
    return docs.withColumn("_key", F.xxhash64("doc_id", "text")).join(leaks, "_key", "left_anti").select(docs.columns)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact_secrets(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary(BYTE_VOCABULARY), SEQUENCE_TOKENS)


STAGES = [
    ("language_id", recognise_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", hide_secrets),
    ("best_fit_packing", pack),
]
#: The language model and the packing have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
