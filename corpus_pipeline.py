"""Corpus pipeline: quality, exact copies, near copies, mixture, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; `run` writes each
stage's result as Parquet to the shared folder and hands it to the next one.
Stages are lazy, so each sets the session to small batches for Python (`bound_batches`) and leaves it so.
All but the last return the columns of ``docs``. The classifier is trained, so
SQL can't give the rows (``ORACLE_SQL`` is None); the tests hold each
stage against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viaduct.llm import exact_dedup, jaccard_join, mixing, packing, quality
from viaduct.llm.common import bound_batches, documents, staged
from viaduct.sources.tables import read_table


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on ``docs`` and the labels, doesn't reject."""
    bound_batches(spark)
    return quality.accepted(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def stage_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct normalised text."""
    bound_batches(spark)
    return exact_dedup.unique_rows(docs)


def stage_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, Jaccard 0.8)."""
    bound_batches(spark)
    return jaccard_join.one_of_each(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    bound_batches(spark)
    return mixing.mixed_rows(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    bound_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", stage_quality),
    ("exact_dedup", stage_exact),
    ("ngram_jaccard_join", stage_near),
    ("mixing", stage_mix),
    ("packing", stage_pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
