"""A corpus pipeline: quality filter, exact and near dedup, mixing of sources, encoding.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from risklens.llm.shared import documents, written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on all labels, accepts."""
    from risklens.llm import quality
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased) the one with the largest doc_id."""
    from risklens.llm import exact_dedup
    return exact_dedup.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: 5-word shingles, similarity 0.8 or more."""
    from risklens.llm import near_dedup
    return near_dedup.keep(docs, words=5, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes."""
    from risklens.llm import mixing
    return mixing.expand(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    from risklens.llm import pieces
    return pieces.encode(docs, pieces.default_model(), lean=True)


STAGES = [("quality", quality_filter), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix_sources), ("encode", encode)]

#: The classifier, the signatures and the rounding draws have no SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs)
    return docs
