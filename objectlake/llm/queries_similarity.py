"""Queries of the similarity joins and vector searches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from objectlake.sampledata import table_path

from .hnsw import nearest
from .similarity import jaccard_components
from .voronoi import top_inner_products


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (4-word shingles, 0.85)."""
    return jaccard_components(spark.read.parquet(table_path(sf_dir, "documents")), k=4, percent=85)


def op6_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 largest integer inner products of every 50th vector."""
    return top_inner_products(spark.read.parquet(table_path(sf_dir, "embeddings")))


def op8_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every 20th vector."""
    return nearest(spark.read.parquet(table_path(sf_dir, "embeddings")))


QUERIES = {"op5_jaccard": op5_jaccard, "op6_voronoi_topk": op6_voronoi_topk, "op8_hnsw": op8_hnsw}
SQL: dict[str, str] = {
    "op6_voronoi_topk": """
WITH ints AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5""".strip()}
