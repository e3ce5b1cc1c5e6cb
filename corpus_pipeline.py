"""From raw documents to packed training sequences, stage by stage.

All stages but the last keep the columns of ``documents``.  Each is written as Parquet and read
again as the next one's input, which also cuts the lineage for lost executors.

Rows without words (null, empty and blank texts among them) fall to the quality rules.  Repeated rows and
rows with equal or null ids are documents of their own; near duplicates are told apart by their texts.
Very long texts pass whole.  Extra columns travel along up to the last stage, whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import mixing, ngram_join, packing, pii, quality_rules
from ledgerloom.session import scratch_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a quality rule rejects go; a text without words is rejected."""
    return quality_rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return ngram_join.first_of_each_group(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; null and empty texts stay as they are."""
    return pii.mask(docs, pii.fit(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources to their target weights: a document stands as often as the mix takes it; a null source is one of its own."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of related documents, as pieces with token ids; a text without tokens is its end mark alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("pii", personal_data),
    ("mixing", mix),
    ("packing", pack),
]
#: SQL has no random field, tokenizer or BM25 walk; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return docs
