"""The corpus pipeline: five stages from documents to packed sequences.

Every stage reads all that its predecessor has written and keeps the columns of documents, but for the last.
n_chars is renewed where a stage changes texts. Empty tables go through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.line_templates import drop_recurring_lines
from wayfare.llm.minhash import one_of_each
from wayfare.llm.packing import pack
from wayfare.llm.quality import fit_quality, good_documents
from wayfare.llm.queries import tokenizer_file
from wayfare.llm.substrings import remove_repeats
from wayfare.sources import scratch


def _as_documents(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, with the length of the text as it is now."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(docs.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labelled ones among them, accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return good_documents(docs, fit_quality(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines whose template recurs; no document goes."""
    return _as_documents(drop_recurring_lines(docs), docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur earlier; no document goes."""
    return _as_documents(remove_repeats(docs), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 4096 tokens."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("minhash near-dedup", minhash_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: Tokenizers and fitted scores cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on what its predecessor has written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch.run_dir(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
