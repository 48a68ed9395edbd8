"""From documents to packed training sequences: five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import mixing, packing, perplexity, secrets, simhash
from tallyframe.llm.common import documents, saved
from tallyframe.llm.queries import tokenizer_file


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within their language's limit."""
    return perplexity.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints link: three-word shingles, at most three differing bits."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, the last one of a source cut."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2,048 tokens with their sequence and place."""
    return packing.pack(docs, tokenizer_file(), size=2048)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix", mix),
    ("pack", pack),
]
#: Perplexity, fingerprints, the forest and the tokenizer can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
