"""Queries of this package over the given tables."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.llm import chat, decontamination, language_id, mtree_search, ngram_jaccard, packing, prefix_trie, secrets, substring_dedup, suffix_dedup, token_alignment, token_counts, url_filter
from adtally.llm.store import table, written

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_MODEL = "piece_bpe_32k.model"
SEQUENCE_TOKENS = 2048
REPEAT_WORDS = 35
REPEAT_BYTES = 100
LENT_TURNS, FAMILY = 8, 5
LEAK_WORDS = 10
URL_RULES = [
    url_filter.Rule.parse(verdict, text)
    for verdict, text in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
]


def vocabulary(name: str) -> str:
    return os.fspath(public_tokenizers.path(name))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out_fold("doc_id"))
    model = language_id.fit(docs.where("doc_id is not null and not held_out"), "doc_id", "text", "lang")
    return language_id.identify(docs, model, keep=["doc_id", "held_out"])


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*secrets.BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return found.select("doc_id", *[count(k) for k in secrets.BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary(WORD_VOCABULARY), SEQUENCE_TOKENS)


def op5_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    formatted = chat.render(chat.fold_events(chat.events_of_turns(turns.union(extra))))
    back = chat.read_back(formatted)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("trained", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), REPEAT_WORDS)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), LEAK_WORDS)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_jaccard.similar_sets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), SEQUENCE_TOKENS)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"), vocabulary(BYTE_VOCABULARY), vocabulary(PIECE_MODEL))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents"), REPEAT_BYTES)
    return kept.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def rebuilt_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns of rebuilt conversations, and all conversations: the first turns come from the family's first one."""
    numbered = written(prefix_trie.number_turns(turns), "numbered")
    said = ["t1", "t2", "t3", "n_bytes"]
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LENT_TURNS + 1)
    convs = numbered.groupBy("conv_id").agg(F.max("position").alias("n")).withColumns({"lent": lent, "base": F.col("conv_id") - F.col("conv_id") % FAMILY})
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = written(convs.join(lengths, "base", "left").withColumn("head", F.least("lent", F.coalesce("base_n", F.lit(0)))), "families")
    heads = numbered.where(F.col("position") <= LENT_TURNS).withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "head").join(heads, "base").where("position <= head").select("conv_id", "position", *said)
    own = numbered.join(convs.select("conv_id", "lent", "head"), "conv_id").where("position > lent")
    return first.union(own.select("conv_id", (F.col("position") - F.col("lent") + F.col("head")).alias("position"), *said)), convs.select("conv_id")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(*rebuilt_conversations(table(spark, sf_dir, "conversations")))


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_url_filter, op3_secret_scan, op4_token_counts, op5_exact_top_k, op6_chat_format, op7_substring_dedup,
        op8_decontamination, op9_ngram_jaccard, op10_best_fit_packing, op11_token_alignment, op12_suffix_dedup, op13_prefix_trie,
    )
}
