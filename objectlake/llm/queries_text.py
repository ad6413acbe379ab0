"""Queries of the tokenizing operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from objectlake.sampledata import table_path

from .pieces import encode
from .token_spans import attribute_tokens


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every whole text, decoded again and compared."""
    return encode(spark.read.parquet(table_path(sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every field of every document."""
    return attribute_tokens(spark.read.parquet(table_path(sf_dir, "documents")))


QUERIES = {"op1_pieces": op1_pieces, "op10_token_counts": op10_token_counts}
SQL: dict[str, str] = {}
