"""Corpus pipeline: quality, exact and near de-duplication, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``.  ``run`` writes every stage's result to the checkpoint folder and
reads it back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import exact_dedup, mixing, near_dedup, packing, quality
from tidewater.llm.common import DOC_COLUMNS, documents, materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labelled rows among them, scores at least 0.5."""
    return quality.accepted(docs.select(*DOC_COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"), threshold=0.5)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one of the largest id."""
    return exact_dedup.drop_duplicates(docs.select(*DOC_COLUMNS), largest=True)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of the smallest id."""
    return near_dedup.drop_near_duplicates(docs.select(*DOC_COLUMNS), threshold=0.8)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to the square root of their sizes, as many characters as there are; repeated rows."""
    return mixing.mix_columns(docs, alpha=0.5, seed="mix")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 4096 tokens; ``row`` tells copies of a document apart."""
    return packing.packed_documents(docs.select(*DOC_COLUMNS), "word_bpe_49k.json", end_id=1, max_tokens=4096)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("MinHash near-dedup", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the classifier, the signatures and the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage{k}")
    return docs
