"""A training-corpus pipeline: quality, language, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet in the
shared folder and reads again as the next stage's docs. All stages but the last return the columns
of `documents`. Nulls, empty texts, repeated rows and empty tables are handled as each operator's
module says: a null or empty text counts as good or poor by the fitted bias, is rejected by language
ID (no letter), and so never reaches the later stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymesh.llm import dedup, language, mixing, packing, quality
from waymesh.llm.common import rows_through, table, written
from waymesh.llm.queries import word_bpe


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of a grade of 1 or more is high enough."""
    graded = quality.graded(table(spark, sf_dir, "labels"))
    judged = lambda d, at: quality.quality(d, graded.withColumnRenamed("doc_id", at["doc_id"]), id_col=at["doc_id"], text_col=at["text"]).filter("NOT quality_rejected")
    return rows_through(docs, judged)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text fits the model of some language."""
    judged = lambda d, at: language.language_id(d, at["text"], at["lang"], at["doc_id"]).filter("NOT lang_rejected")
    return rows_through(docs, judged)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8)."""
    return rows_through(docs, lambda d, at: dedup.deduplicated(d, at["doc_id"], text_col=at["text"], k=5, percent=80))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the target weights; those drawn in two epochs stand twice."""
    return rows_through(docs, lambda d, at: mixing.mix(d, id_col=at["doc_id"], text_col=at["text"], lang_col=at["lang"], source_col=at["source"]))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 4096 tokens."""
    return packing.pack(docs, word_bpe())


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("MinHash near-dedup", dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

# The stages train models and pack by search, which SQL can't express; tests use brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
