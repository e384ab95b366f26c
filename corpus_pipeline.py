"""A training-data pipeline over ``documents``: five operators, each on what the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontaminate import without_overlaps
from tidemark.llm.jaccard_join import first_of_groups
from tidemark.llm.packing import pack
from tidemark.llm.quality import kept
from tidemark.llm.sanitise import sanitised
from tidemark.llm.text import documents, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each component; one without an id only where no other is."""
    return first_of_groups(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_overlaps(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, with personal data and words that disclose it replaced."""
    return sanitised(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: Trained scores, near duplicates and byte-pair ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
