"""Exact centroid clustering of integer vectors, filtered by n-simplex projection.

Some vectors are pivots.  Their mutual distances span a simplex with its pivots
in as many dimensions, less one; a vector's distances to the pivots, computed once
and kept, make it the apex of one more simplex over that base: its coordinates are
those of its foot in the base, and its height above it.  Of two apexes with feet
f, g and heights a, b the vectors are at least |f-g|^2 + (a-b)^2 and at most
|f-g|^2 + (a+b)^2 apart (squared), so a centroid whose lower bound is above the least upper
bound can't be nearest.  Only centroids that may be nearest are compared, by
exact integers.  Rounding in the projection is allowed for by a margin, so it
can only let more centroids through.

The first centroids are the first pivots; after the first round its centroids become
pivots too and the distances to all of them are kept anew.  A vector and a centroid are
the better bounded the nearer the centroid is to the pivots' span, and later centroids stay near these.

A round is one pass over the kept table: tasks send a row of sums for each
centroid, Spark adds them up, and the new centroids (their number times their
length, whatever the table's size) go to the next round by the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, stage

#: pivots at most, and how high over the earlier ones each must stand, as a share of
#: the largest distance of pivots (flat simplexes round badly)
PIVOTS, FLAT = 32, 1e-3
#: the bounds' margin, as a share of the largest squared distance to a pivot
MARGIN = 1e-9
#: components up to this size keep squared distances within a long
LARGEST = 1 << 27
BLOCK, PAIRS = 16384, 1 << 15     # vectors projected, and vectors compared, at once


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all of ``b`` (integers)."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if 4.0 * most * most * max(a.shape[1], 1) < 2.0 ** 52:
        a, b = a.astype(np.float64), b.astype(np.float64)       # exact there, and faster
    return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)).astype(np.int64)


@dataclass
class Base:
    """The simplex of the pivots."""
    pivots: np.ndarray      # integer vectors, the first one the origin
    corner: np.ndarray      # lower triangular: row i holds pivot i + 1
    margin: float

    @classmethod
    def over(cls, some: np.ndarray, pivots: int = PIVOTS) -> "Base":
        """The simplex over the first of ``some``, each far enough from the earlier ones' span."""
        apart = squared(some, some).astype(np.float64)
        flat = (FLAT * np.sqrt(apart.max(initial=0.0))) if len(some) else 0.0
        chosen, corner = [0], np.zeros((0, 0))
        for i in range(1, len(some)):
            if len(chosen) == pivots:
                break
            # the inner products with the earlier pivots, from distances alone
            wanted = (apart[i, 0] + apart[0, chosen[1:]] - apart[i, chosen[1:]]) / 2
            foot = np.linalg.solve(corner, wanted) if len(corner) else wanted
            height = apart[i, 0] - foot @ foot
            if height > max(flat * flat, 0.0):
                n = len(corner)
                grown = np.zeros((n + 1, n + 1))
                grown[:n, :n], grown[n, :n], grown[n, n] = corner, foot, np.sqrt(height)
                corner = grown
                chosen.append(i)
        bend = np.linalg.cond(corner) if len(corner) else 1.0
        return cls(some[chosen], corner, MARGIN * bend)

    def apexes(self, distances: np.ndarray) -> np.ndarray:
        """The apex (foot, height) over the base of each row of squared distances to the pivots."""
        d = distances.astype(np.float64)
        if not len(self.corner):
            return np.sqrt(d)
        sides = (self.corner ** 2).sum(1)
        foot = np.linalg.solve(self.corner, ((d[:, :1] + sides - d[:, 1:]) / 2).T).T
        return np.concatenate([foot, np.sqrt(np.maximum(d[:, 0] - (foot * foot).sum(1), 0))[:, None]], 1)

    def maybe_nearest(self, apex: np.ndarray, centroids: np.ndarray) -> np.ndarray:
        """Which centroids (columns) may be nearest to each vector, by the
        apexes of both; the nearest one always is among them."""
        foot, height = apex[:, :-1], apex[:, -1:]
        c_foot, c_height = centroids[:, :-1], centroids[:, -1]
        size = (apex * apex).sum(1)[:, None] + (centroids * centroids).sum(1)[None]
        flat = size - 2 * (foot @ c_foot.T)             # |f-g|^2 + a^2 + b^2
        across = 2 * height * c_height
        least = (flat + across).min(1, keepdims=True)
        return flat - across <= least + self.margin * (size.max(1, keepdims=True) + 1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid of those that ``maybe`` names (the
    smaller number of equals) and the exact squared distance."""
    row, column = np.nonzero(maybe)
    distance = np.empty(len(row), np.int64)
    for at in range(0, len(row), PAIRS):
        r, c = row[at:at + PAIRS], column[at:at + PAIRS]
        difference = vectors[r] - centroids[c]
        distance[at:at + PAIRS] = (difference * difference).sum(1)
    first = np.searchsorted(row, np.arange(len(vectors)))
    least = np.minimum.reduceat(distance, first) if len(first) else np.zeros(0, np.int64)
    hit = np.flatnonzero(distance == least[row])
    _, at = np.unique(row[hit], return_index=True)
    return column[hit[at]], least


def rows_of(column, kind) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1)


def assigned(batches, base: Base, centroids: np.ndarray):
    """For each block of rows: the block, its vectors, each row's centroid, the distance,
    and the number of centroids compared."""
    apexes = base.apexes(squared(centroids, base.pivots))
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            b = batch.slice(at, BLOCK)
            vectors = rows_of(b.column("vector"), np.int64)
            maybe = base.maybe_nearest(rows_of(b.column("apex"), np.float64), apexes)
            cluster, distance = nearest(vectors, centroids, maybe)
            yield b, vectors, cluster, distance, maybe.sum(1)


def kept_vectors(table: DataFrame, size: int, scale: int) -> DataFrame:
    """``vec_id`` and ``vector``, the floor of ``scale`` times each component,
    of rows whose embedding has ``size`` components, all of them finite."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))

    def whole(x: Column) -> Column:
        value = F.floor(x * F.lit(float(scale)))
        wide = F.raise_error(F.lit(f"a component beyond {LARGEST / scale:.0f}: squared distances would not fit a long"))
        return F.when(F.abs(x) * scale > LARGEST, wide.cast("long")).otherwise(value.cast("long"))
    rows = pick(table, "vec_id", "embedding").select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.where((F.size("embedding") == size) & F.forall("embedding", fine)).select("vec_id", F.transform("embedding", whole).alias("vector"))


def cluster_vectors(table: DataFrame, clusters: int = 16, rounds: int = 3, size: int = 64, scale: int = 64,
                    seed: int = 1, pivots: int = PIVOTS) -> DataFrame:
    """Lloyd's rounds over the rows of ``table`` (vec_id, embedding) whose
    vector has ``size`` finite components, as integers: ``vec_id``, ``cluster``,
    ``distance`` (squared, to its centroid), ``cluster_inertia``, ``inertia``,
    ``centroid_sha256`` and ``compared`` (centroids that the bounds left to compare).

    The first centroids are the vectors whose ids have the smallest sha256 of
    ``<seed>:<vec_id>`` (ties: the smaller vector).  A new centroid is
    the floor of its vectors' mean; an empty one stays; ties go to the smaller number.
    Repeated rows take part as often as they occur, and rows without an id too, but they
    start no centroid.  Fewer rows with an id than ``clusters``: as many centroids as rows;
    none: no result.  A component beyond 2^27 / ``scale`` ends the run with an
    error that says so.  Further columns are ignored."""
    if not clusters or clusters < 1 or size < 1 or pivots < 1:
        raise ValueError("clusters, size and pivots must be positive")
    spark = table.sparkSession
    kept = kept_vectors(table, size, scale)
    first = kept.where("vec_id is not null").orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256), "vector").limit(clusters).collect()
    if not first:
        return spark.createDataFrame([], SHAPE)
    centroids = np.array([r["vector"] for r in first], np.int64)
    first_centroids, base = centroids, Base.over(centroids, pivots)

    def project(rows: DataFrame) -> DataFrame:
        """``rows`` with the apexes over the base, kept as a table."""
        def cached(batches, base=base):
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK):
                    b = batch.slice(at, BLOCK)
                    column = b.column("vector")
                    vectors = rows_of(column, np.int64) if pa.types.is_binary(column.type) else column.flatten().to_numpy().reshape(-1, size)
                    apexes = base.apexes(squared(vectors, base.pivots))
                    yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array([v.tobytes() for v in vectors], pa.binary()),
                                                      pa.array([a.tobytes() for a in apexes], pa.binary())], names=["vec_id", "vector", "apex"])
        return stage(rows.mapInArrow(cached, "vec_id long, vector binary, apex binary"), "simplex")
    projected = project(kept)
    columns = [f"s{i}" for i in range(size)]
    for done in range(rounds):
        if done == 1:       # the centroids have left the first ones: theirs is the base from here on
            base = Base.over(np.concatenate([centroids, first_centroids]), pivots)
            projected = project(projected.select("vec_id", "vector"))

        def sums(batches, centroids=centroids, base=base):
            total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
            for _, vectors, cluster, _, _ in assigned(batches, base, centroids):
                order = np.argsort(cluster, kind="stable")
                ids, at = np.unique(cluster[order], return_index=True)
                total[ids] += np.add.reduceat(vectors[order], at)
                count += np.bincount(cluster, minlength=len(count))
            some = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(count[some]), *[pa.array(total[some, i]) for i in range(size)]],
                                             names=["cluster", "n", *columns])
        parts = projected.mapInArrow(sums, "cluster int, n long, " + ", ".join(f"{c} long" for c in columns))
        centroids = centroids.copy()
        for r in parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in ("n", *columns)]).collect():     # a row a centroid
            centroids[r["cluster"]] = np.array([r[c] for c in columns]) // r["n"]

    def final(batches):
        for b, _, cluster, distance, compared in assigned(batches, base, centroids):
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(compared, pa.int32())],
                                             names=["vec_id", "cluster", "distance", "compared"])
    rows = stage(projected.mapInArrow(final, "vec_id long, cluster int, distance long, compared int"), "simplex-clusters")
    inertia = {r["cluster"]: r["d"] for r in rows.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}     # a row a centroid
    facts = [(c, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
             for c, d in sorted(inertia.items())]
    told = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")


SHAPE = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string, compared int"
