"""The registered queries of the training-data operators: each applies its operator to its
whole table with the production parameters and derives the digest columns from the output."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlens.llm import (
    bpe, chat, divergence, langid, licenses, packing, prefixtrie, quality, repeats, sharding, simhash, topk, urlfilter)

URL_RULES = (
    urlfilter.Rule("allow", "org", "/"),
    urlfilter.Rule("block", "example.org", "/es/"),
    urlfilter.Rule("block", "example.org", "/en/1"),
    urlfilter.Rule("allow", "com", "/fr/"),
    urlfilter.Rule("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    apart = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.train(docs.filter(~apart)))
    return found.select("doc_id", apart.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.with_probe(_table(spark, sf_dir, "conversations"), spark)
    got = chat.read_back(chat.expand_prefixes(turns))
    return got.select(
        "conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars", "n_targets")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_length=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    back = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), *rules), *rules)
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"), URL_RULES)


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, radius=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "margin")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    narrow = _table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffle_into_shards(narrow, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=3, top_terms=200)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixtrie.numbered(_table(spark, sf_dir, "conversations"))
    return prefixtrie.trie(*prefixtrie.rebuilt(turns))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"), "score", F.size("spans").alias("n_spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_url_filter": op5_url_filter,
    "op6_exact_topk": op6_exact_topk,
    "op7_simhash": op7_simhash,
    "op8_quality_rules": op8_quality_rules,
    "op9_sharding": op9_sharding,
    "op10_packing": op10_packing,
    "op11_source_divergence": op11_source_divergence,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_license_scan": op13_license_scan,
}
