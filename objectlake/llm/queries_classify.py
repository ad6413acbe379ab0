"""Queries of the classifiers and of the search for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from objectlake.sampledata import table_path

from . import private_data, quality, toxicity


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every whole text."""
    docs, labels = (spark.read.parquet(table_path(sf_dir, t)) for t in ("documents", "labels"))
    return quality.score_quality(docs, quality.train(docs, labels))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every whole text."""
    docs, labels = (spark.read.parquet(table_path(sf_dir, t)) for t in ("documents", "labels"))
    return toxicity.score_toxicity(docs, toxicity.train(docs, labels))


def op9_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data in every whole text."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    return private_data.find_private(docs, private_data.train(docs))


QUERIES = {"op4_quality": op4_quality, "op7_toxicity": op7_toxicity, "op9_private_data": op9_private_data}
SQL: dict[str, str] = {}
