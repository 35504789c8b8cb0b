"""The corpus pipeline: stages over the documents, each written and read again as the next one's input.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame.  All but the
last return the columns of ``documents``; the last returns the encoded documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roomtrace.llm import decontaminate, ngram_join, quality_gam, quality_rules, trie_bpe
from roomtrace.llm.tables import read
from roomtrace.session import work_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return quality_gam.keep(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned cutoffs."""
    return quality_rules.keep(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.keep(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return decontaminate.keep(docs, read(spark, sf_dir, "benchmark", "item_id", "text"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as token ids, and digests of the ids and of the text decoded from them."""
    return trie_bpe.digests(trie_bpe.encode(docs, trie_bpe.vocabulary("byte_bpe_50k.json")), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("BPE encoding", encoding),
]

#: The trained classifier decides which documents go on, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = work_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
