"""The subpackage's queries and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_batch, queries_classify, queries_native, queries_similarity, queries_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
for _module in (queries_native, queries_text, queries_similarity, queries_classify, queries_batch):
    QUERIES.update(_module.QUERIES)
    SQL.update(_module.SQL)
