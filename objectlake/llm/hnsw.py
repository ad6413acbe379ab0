"""Approximate nearest neighbours: a hierarchical navigable small-world graph
for each shard, stored as flat neighbour arrays, and the shards' results merged.

Largest inner product: vectors get one more component that gives all the same
length, so that the nearest by angle is the one with the largest inner product.
Equal vectors are one point of the graph, with all their ids.  Points are put
into the graph in batches: each batch searches the graph of those before it,
sees its own members directly, and keeps neighbours that are nearer to it than
to each other.  Searches run in step for many queries at once.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .vectors import matrix, usable

SHARD_ROWS = 16_384     # rows of a shard, about
LINKS = 16              # neighbours above the ground level; twice as many on it
BUILD_WIDTH, SEARCH_WIDTH = 64, 128


def spread_out(points: np.ndarray, near: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of each row's neighbours ``near`` (-1: none; with their ``sims``) up to
    ``most``: those nearer to the point than to any kept before, then the nearest of the rest."""
    order = np.argsort(-sims, axis=1, kind="stable")
    near, sims = np.take_along_axis(near, order, 1), np.take_along_axis(sims, order, 1)
    among = points[np.maximum(near, 0)]
    between = np.matmul(among, among.transpose(0, 2, 1))
    kept = np.zeros(near.shape, bool)
    for c in range(near.shape[1]):
        closest = np.where(kept, between[:, c, :], -np.inf).max(1)
        kept[:, c] = (near[:, c] >= 0) & (sims[:, c] > closest) & (kept.sum(1) < most)
    rank = np.where(near >= 0, np.where(kept, 0, 1), 2)
    order = np.argsort(rank, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(near, order, 1)


def search(points: np.ndarray, links: np.ndarray, queries: np.ndarray, begin: np.ndarray, width: int, at_once: int = 4):
    """The best ``width`` points each query meets on one level (ids -1 where
    fewer) and their inner products, from the points ``begin``."""
    n = len(queries)
    rows = np.arange(n)
    ids = np.full((n, width), -1, np.int64)
    sims = np.full((n, width), -np.inf, np.float32)
    opened = np.ones((n, width), bool)
    seen = np.zeros((n, len(points)), bool)
    ids[:, 0], opened[:, 0] = begin, False
    sims[:, 0] = (points[begin] * queries).sum(1)
    seen[rows, begin] = True
    while len(rows):
        open_sims = np.where(opened[rows], -np.inf, sims[rows])
        top = np.argpartition(-open_sims, min(at_once, width) - 1, axis=1)[:, :at_once]
        live = np.take_along_axis(open_sims, top, 1) > -np.inf
        going = live.any(1)
        rows, top, live = rows[going], top[going], live[going]
        if not len(rows):
            break
        np.put_along_axis(marks := opened[rows], top, True, 1)
        opened[rows] = marks
        next_ = np.where(live[:, :, None], links[np.take_along_axis(ids[rows], top, 1)], -1).reshape(len(rows), -1)
        next_.sort(axis=1)
        fresh = (next_ >= 0) & ~np.take_along_axis(seen[rows], np.maximum(next_, 0), 1)
        fresh[:, 1:] &= next_[:, 1:] != next_[:, :-1]
        at, col = np.nonzero(fresh)
        seen[rows[at], next_[at, col]] = True
        new = np.full(next_.shape, -np.inf, np.float32)
        new[at, col] = np.einsum("ij,ij->i", points[next_[at, col]], queries[rows[at]])
        all_sims = np.concatenate([sims[rows], new], 1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[rows] = np.take_along_axis(all_sims, best, 1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(fresh, next_, -1)], 1), best, 1)
        opened[rows] = np.take_along_axis(np.concatenate([opened[rows], ~fresh], 1), best, 1)
    return ids, sims


def connect(points: np.ndarray, most: int, seed: int) -> np.ndarray:
    """The neighbours (n x ``most``, -1: none) of one level, by batches."""
    n = len(points)
    links = np.full((n, most), -1, np.int64)
    done = 0
    while done < n:
        batch = np.arange(done, min(n, done + max(512, min(1024, done))))
        sims = points[batch] @ points[batch].T
        np.fill_diagonal(sims, -np.inf)
        own = min(BUILD_WIDTH, len(batch))
        near = np.argpartition(-sims, own - 1, axis=1)[:, :own]
        near_sims = np.take_along_axis(sims, near, 1)
        near = np.where(np.isfinite(near_sims), batch[near], -1)
        if done:
            begin = np.random.RandomState(seed + done).randint(0, done, len(batch))
            old, old_sims = search(points[:done], links[:done], points[batch], begin, BUILD_WIDTH)
            near, near_sims = np.concatenate([near, old], 1), np.concatenate([near_sims, old_sims], 1)
            top = np.argsort(-near_sims, axis=1)[:, :BUILD_WIDTH]
            near, near_sims = np.take_along_axis(near, top, 1), np.take_along_axis(near_sims, top, 1)
        links[batch] = padded(spread_out(points, near, near_sims, most), most)
        # and back: whoever was chosen takes the nearest of old and new neighbours into account
        a = np.repeat(batch, most)
        b = links[batch].ravel()
        a, b = a[b >= 0], b[b >= 0]
        order = np.lexsort((-(points[a] * points[b]).sum(1), b))
        a, b = a[order], b[order]
        place = np.arange(len(b)) - np.searchsorted(b, b)
        a, b, place = a[place < most], b[place < most], place[place < most]
        met, row = np.unique(b, return_inverse=True)
        new = np.full((len(met), most), -1, np.int64)
        new[row, place] = a
        new[(new[:, :, None] == links[met][:, None, :]).any(2)] = -1
        for at in range(0, len(met), 1024):
            m = met[at:at + 1024]
            both = np.concatenate([links[m], new[at:at + 1024]], 1)
            both_sims = np.where(both >= 0, np.einsum("ijk,ik->ij", points[np.maximum(both, 0)], points[m]), -np.inf)
            links[m] = padded(spread_out(points, both, both_sims, most), most)
        done += len(batch)
    return links


def padded(x: np.ndarray, width: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, width - x.shape[1])), constant_values=-1) if x.shape[1] < width else x


def build(ids: np.ndarray, vectors: np.ndarray, k: int, seed: int = 5) -> dict[str, np.ndarray]:
    """The flat arrays of a shard's graph.  ``level_i`` lists the points of
    level i above the ground, ``links_i`` their neighbours as places in it."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    _, first, same = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    same = same.ravel()
    mixed = np.random.RandomState(seed).permutation(len(first))   # points in a random order
    name = np.empty(len(first), np.int64)
    name[mixed] = np.arange(len(first))
    point = name[same]
    own = np.argsort(point, kind="stable")
    begins = np.searchsorted(point[own], np.arange(len(first) + 1))
    x = vectors[first[mixed]]
    length = np.sqrt((x ** 2).sum(1))
    unit = x / max(length.max(), 1e-300)
    level = np.column_stack([unit, np.sqrt(np.maximum(0, 1 - (unit ** 2).sum(1)))]).astype(np.float32)
    out = {"ids": ids[own], "begins": begins, "vectors": x, "points": level, "links_0": connect(level, 2 * LINKS, seed).astype(np.int32)}
    height = np.floor(-np.log(np.random.RandomState(seed + 1).uniform(1e-12, 1, len(x))) / np.log(LINKS)).astype(int)
    for i in range(1, max(1, height.max() + 1)):
        members = np.flatnonzero(height >= i)
        out[f"level_{i}"] = members
        out[f"links_{i}"] = connect(level[members], LINKS, seed).astype(np.int32)
    return out


def look_up(index: dict[str, np.ndarray], queries: np.ndarray, width: int) -> np.ndarray:
    """The points (-1: none) that the searches down the levels end with."""
    levels = sorted(int(n[6:]) for n in index if n.startswith("level_"))
    points = index["points"]
    longest = np.abs(queries).max(axis=1, keepdims=True)
    q = queries / np.maximum(longest, 1e-300)
    q = np.column_stack([q, np.zeros(len(q))]).astype(np.float32)
    at = np.full(len(q), index[f"level_{levels[-1]}"][0] if levels else 0)
    for i in reversed(levels):
        members = index[f"level_{i}"]
        begin = np.searchsorted(members, at)
        found, sims = search(points[members], index[f"links_{i}"], q, begin, 8)
        at = members[found[np.arange(len(q)), sims.argmax(1)]]
    return search(points, index["links_0"], q, at, min(width, max(1, len(points))))[0]


def nearest(table: DataFrame, k: int = 20, every: int = 20, width: int = SEARCH_WIDTH, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``table``
    (``vec_id``, ``embedding``) whose id is divisible by ``every``, the ``k`` other
    ids found with the largest inner product, which is the score.

    Null ids, and vectors that are null, empty, all zero, not of the commonest
    length or hold null or non-finite components, take no part; rows that repeat
    id and vector count once.  Ties go to smaller ids.  All rows are indexed;
    an empty table, or one without queries, gives no rows."""
    rows = usable(table, True, "hnsw-in")
    n = rows.count()
    shards = max(1, -(-n // shard_rows))

    def built(t: pa.Table) -> pa.Table:
        raw = io.BytesIO()
        np.savez(raw, **build(np.array(t.column("vec_id")), matrix(t.column("vector")), k))
        return pa.table({"shard": t.column("shard")[:1], "graph": pa.array([raw.getvalue()], pa.binary())})
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(shards)).cast("int"))
    index = stage(sharded.groupBy("shard").applyInArrow(built, "shard int, graph binary"), "hnsw-index")
    asked = rows.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), "vec_id", F.col("vector").alias("data"))
    graphs = index.select("shard", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("vec_id"), F.col("graph").alias("data"))

    def found_in(graph: dict[str, np.ndarray], q: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        own, begins = graph["ids"], graph["begins"]
        found = look_up(graph, q, max(width, k + 1))
        row, col = np.nonzero(found >= 0)
        point = found[row, col]
        score = (graph["vectors"][point] * q[row]).sum(1)
        many = np.minimum(begins[point + 1] - begins[point], k + 1)
        row, score = np.repeat(row, many), np.repeat(score, many)
        vec = own[np.repeat(begins[point] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        ok = vec != names[row]
        row, score, vec = row[ok], score[ok], vec[ok]
        order = np.lexsort((vec, -score, row))
        row, score, vec = row[order], score[order], vec[order]
        few = np.arange(len(row)) - np.searchsorted(row, row) < k
        return pa.RecordBatch.from_arrays([pa.array(names[row[few]], pa.int64()), pa.array(vec[few], pa.int64()), pa.array(score[few], pa.float64())],
                                          names=["query_id", "vec_id", "score"])

    def answered(batches):
        graph, shard = {}, -1       # a shard's graph comes before its queries; a shard without rows has none
        for b in batches:
            begins = [0, *(np.flatnonzero(np.array(b.column("kind")) == 0)).tolist(), b.num_rows]
            for i, (at, end) in enumerate(zip(begins, begins[1:])):
                if i:
                    graph, shard = {}, b.column("shard")[at].as_py()
                    graph = dict(np.load(io.BytesIO(b.column("data")[at].as_buffer())))
                    at += 1
                asks = b.slice(at, end - at)
                asks = asks.filter(pa.array(np.array(asks.column("shard")) == shard))
                for first in range(0, asks.num_rows, 512):
                    some = asks.slice(first, 512)
                    yield found_in(graph, matrix(some.column("data")), np.array(some.column("vec_id")))
    met = asked.unionByName(graphs).repartition(shards, "shard").sortWithinPartitions("shard", "kind")
    found = met.mapInArrow(answered, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
