"""The corpus pipeline: quality rules, language ID, SimHash near-dedup, suffix-array dedup,
best-fit packing, each applied to all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``.  ``run`` writes each stage's result as Parquet into the shared folder
of ``spark.checkpoint.dir`` and reads it again as the next stage's input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termlens.llm import langid, packing, quality, repeats, simhash
from termlens.llm.common import shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
SHINGLE, RADIUS = 3, 3
MIN_SHARE = 0.3
MIN_LENGTH = 100
CAPACITY = 2048

#: SQL expresses neither the forest's nor the language model's verdicts.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or a forest go."""
    return quality.keep_good(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, without a language of ``MIN_SHARE`` of their letters, with most
    letters in scripts no learned language uses, or whose letter sequences are foreign to their
    languages (an unlearned language of the same script, random letters) go."""
    return langid.keep_identified(docs.select(*COLUMNS), min_score=MIN_SHARE)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id."""
    return simhash.keep_one(docs.select(*COLUMNS), SHINGLE, RADIUS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of passages of 100 bytes or more leave the texts; every document stays, and
    n_chars counts what is left of it."""
    return (
        repeats.without_repeats(docs.select(*COLUMNS), MIN_LENGTH)
        .withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(
            F.col("n_chars")))
        .select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's result.  A stage's table is deleted once the
    next one is written whole."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    home = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{home}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
