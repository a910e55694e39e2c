"""A training-data pipeline over `documents`: every stage takes what the one before kept, written and read again.

quality (empirical Bayes classifier), near duplicates (SimHash), decontamination (SimHash windows), mixing to target
weights, token ids in binary shards. All stages but the last return the columns of `documents`.

Defined cases: those of the operators. After mixing, a document may stand there up to three times, each time with its id;
the token files hold every one of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitide.llm import decontaminate, mixing, quality, simhash, tokenids
from epitide.llm.queries import END_ID, table, tokenizer_path
from epitide.sources.stage import settle


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject for low quality or toxicity."""
    labels = quality.one_label(table(spark, sf_dir, "labels"), "doc_id", "quality", "toxic")
    return quality.keep_good(docs, labels, "doc_id", "text", "source", "lang")


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return simhash.keep_one(docs, "doc_id", "text")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    sized = docs.select("source", mixing.word_count("text").alias("size"))
    goals = settle(mixing.targets(mixing.cycled_weights(mixing.source_sizes(sized, "source", F.col("size")))), "goals")
    return mixing.mix(docs, "doc_id", "source", "text", goals)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, from the written files: doc_id, start, n_tokens, ids_crc32, indexed."""
    return tokenids.encoded(docs, "doc_id", "text", tokenizer_path(), END_ID).withColumnRenamed("key", "doc_id")


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", distinct_texts),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_ids", token_ids),
]

# Training, link search and tokenization have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
