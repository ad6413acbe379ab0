"""Reading vector tables for the searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stage


def usable(table: DataFrame, nonzero: bool, name: str) -> DataFrame:
    """``vec_id`` and ``vector`` (its doubles as bytes) of the rows that take
    part: with an id and a vector of the table's commonest length without null,
    NaN or infinite components (and, if ``nonzero``, not all zero).  Rows that
    repeat both count once."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = pick(table, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", fine))
    if nonzero:
        rows = rows.where(F.exists("embedding", lambda x: x != 0))
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("embedding") == (size["n"] if size else -1))

    def packed(batches):
        for b in batches:
            values = b.column("embedding").flatten().to_numpy(zero_copy_only=False) + 0.0     # -0.0 as 0.0
            vectors = values.reshape(b.num_rows, -1) if b.num_rows else values
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([v.tobytes() for v in vectors], pa.binary())], names=["vec_id", "vector"])
    return stage(rows.mapInArrow(packed, "vec_id long, vector binary").distinct(), name)


def matrix(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.zeros((0, 0))
