"""Exact top-k by a Voronoi kNN join, largest integer inner product first.

Pivots part queries and data into cells.  Summaries of the cells (rows, radius,
longest vector, landmarks: the vectors nearest the pivot) come to the driver, a
few numbers a cell.  A query q has at least the k-th best of its scores with
the landmarks; a cell with pivot p and radius u can matter to it only if
q.p + |q| u and |q| times the longest vector reach that score.  Neighbouring
cells are packed to groups, the queries' and the data's each to the size of a
local join; a group of data is copied to a group of queries only if it can
matter to one of them, and goes with the queries it can matter to.  Each pair
is solved locally, cell by cell under the same bounds, and the best are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .vectors import matrix, usable

#: the number of pivots is the square root of the rows, at most this, chosen from SAMPLE
#: times as many rows; cells with more rows than a local join takes are split by a hash
MOST_PIVOTS, SAMPLE = 512, 4
BLOCK, VECTORS = 1024, 8192     # queries and vectors of one local join


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in doubles where these are exact."""
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if largest < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's ``k`` largest scores, ties to smaller ids."""
    by_id = np.argsort(ids, kind="stable")
    s = scores[:, by_id]
    if s.shape[1] > k:
        kth = -np.partition(-s, k - 1, axis=1)[:, k - 1:k]
        order = np.full((len(s), k), 0)
        for r in range(len(s)):
            at = np.flatnonzero(s[r] >= kth[r])
            order[r] = at[np.argsort(-s[r, at], kind="stable")[:k]]
    else:
        order = np.argsort(-s, axis=1, kind="stable")
    return by_id[order]


def spread(sample: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` different rows of ``sample``, each the one farthest from
    those before it, so that clusters have pivots of their own."""
    picked, far = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(picked) < most and far.max() > 0:
        picked.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[picked[-1]]) ** 2).sum(1))
    return sample[picked]


def chained(pivot: np.ndarray) -> list[int]:
    """The pivots in an order in which each is followed by the nearest one left."""
    left, order = set(range(1, len(pivot))), [0]
    while left:
        rest = np.array(sorted(left))
        order.append(int(rest[((pivot[rest] - pivot[order[-1]]) ** 2).sum(1).argmin()]))
        left.remove(order[-1])
    return order


def packed(order: list[int], counts: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each cell, cells in ``order`` sharing one up to ``limit``
    rows, and the parts that each group's rows need for ``limit`` rows a part."""
    group, held = np.zeros(len(counts), np.int64), [0]
    for c in order:
        if held[-1] and held[-1] + counts[c] > limit:
            held.append(0)
        group[c] = len(held) - 1
        held[-1] += int(counts[c])
    return group, np.maximum(1, -(-np.array(held) // limit))


@dataclass
class Cells:
    """Pivots, the data's summaries by cell, and the groups of data cells."""
    pivot: np.ndarray
    scale: float
    radius: np.ndarray
    longest: np.ndarray
    group: np.ndarray

    def ints(self, column) -> np.ndarray:
        return np.floor(self.scale * matrix(column))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        far = (x ** 2).sum(1)[:, None] + (self.pivot ** 2).sum(1) - 2 * x @ self.pivot.T
        cell = far.argmin(1)
        return cell, np.sqrt(((x - self.pivot[cell]) ** 2).sum(1))

    def reach(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether each cell can hold a vector that scores ``least`` with each query."""
        length = np.sqrt((q ** 2).sum(1))[:, None]
        bound = np.minimum(q @ self.pivot.T + length * self.radius, length * self.longest)
        return (self.radius >= 0) & (bound + 1e-9 * length * self.longest + 1e-3 >= least[:, None])


def routed(table: DataFrame, k: int, every: int, scale: float) -> tuple[DataFrame, DataFrame, DataFrame, Cells] | None:
    """The steps before the join: rows (``vec_id``, ``vector``, ``cell``, ``grp``,
    ``part``), queries (``vec_id``, ``vector``, ``least`` score that matters,
    their ``own`` group and ``share`` of it, and ``grps``, the groups of data
    that can matter), groups (``grp``, ``parts``, ``n`` rows) and the cells.
    None if there are no queries."""
    rows = usable(table, False, "voronoi-in")
    spark, n = rows.sparkSession, rows.count()
    most = max(1, min(MOST_PIVOTS, int(np.ceil(np.sqrt(n)))))
    chosen = rows.orderBy(F.xxhash64("vec_id", "vector"), "vec_id").limit(SAMPLE * most).select("vector").collect()
    if not chosen or rows.where(F.col("vec_id") % every == 0).isEmpty():
        return None
    pivot = spread(np.floor(scale * np.stack([np.frombuffer(r["vector"], np.float64) for r in chosen])), most)
    none = np.full(len(pivot), -1.0)
    cells = Cells(pivot, scale, none, none, none.astype(int))

    def placed(batches):
        for b in batches:
            x = cells.ints(b.column("vector"))
            if len(x):
                cell, far = cells.nearest(x)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("vector"), pa.array(cell, pa.int32()), pa.array(far),
                                                  pa.array(np.sqrt((x ** 2).sum(1)))], names=["vec_id", "vector", "cell", "far", "length"])
    rows = stage(rows.mapInArrow(placed, "vec_id long, vector binary, cell int, far double, length double"), "voronoi-cells")
    is_query = F.col("vec_id") % every == 0
    held, asked = np.zeros(len(pivot), np.int64), np.zeros(len(pivot), np.int64)
    radius, longest = none.copy(), none.copy()
    for r in rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max("far").alias("far"),
                                      F.max("length").alias("length")).collect():
        held[r["cell"]], asked[r["cell"]], radius[r["cell"]], longest[r["cell"]] = r["n"], r["q"], r["far"], r["length"]
    order = chained(pivot)
    group, parts = packed(order, held, VECTORS)
    own, shares = packed(order, asked, BLOCK)
    cells = Cells(pivot, scale, radius, longest, group)
    place = F.row_number().over(Window.partitionBy("cell").orderBy("far", "vec_id"))
    near = rows.select("cell", "far", "vec_id", "vector").withColumn("place", place).where(F.col("place") <= k + 1) \
        .select("vec_id", "vector").collect()
    landmark_ids = np.array([r["vec_id"] for r in near])
    landmarks = np.floor(scale * np.stack([np.frombuffer(r["vector"], np.float64) for r in near]))

    def routes(batches):
        for b in batches:
            q = cells.ints(b.column("vector"))
            for at in range(0, len(q), 256):
                piece, x = b.slice(at, 256), q[at:at + 256]
                scores = products(x, landmarks).astype(float)
                scores[np.array(piece.column("vec_id"))[:, None] == landmark_ids] = -np.inf
                least = -np.partition(-scores, k - 1, axis=1)[:, k - 1] if scores.shape[1] >= k else np.full(len(x), -np.inf)
                reach = cells.reach(x, least)
                grps = [np.unique(cells.group[r]) for r in reach]
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), piece.column("vector"), pa.array(least), piece.column("cell"),
                                                  pa.array(grps, pa.list_(pa.int64()))], names=["vec_id", "vector", "least", "cell", "grps"])
    maps = spark.createDataFrame([(c, int(group[c]), int(parts[group[c]]), int(own[c]), int(shares[own[c]])) for c in range(len(pivot))],
                                 "cell int, grp long, parts long, own long, shares long")
    h = F.xxhash64("vec_id", "vector")
    queries = rows.where(is_query).select("vec_id", "vector", "cell").mapInArrow(
        routes, "vec_id long, vector binary, least double, cell int, grps array<long>")
    queries = stage(queries.join(F.broadcast(maps), "cell").select(
        "vec_id", "vector", "least", "own", F.pmod(h, "shares").alias("share"), "grps"), "voronoi-routes")
    rows = rows.join(F.broadcast(maps), "cell").select("vec_id", "vector", "cell", "grp", F.pmod(h, "parts").alias("part"))
    totals = [int(held[group == g].sum()) for g in range(len(parts))]
    groups = spark.createDataFrame([(g, int(p), m) for g, (p, m) in enumerate(zip(parts, totals))], "grp long, parts long, n long")
    return rows, queries, groups, cells


def compared_share(table: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0) -> float:
    """The part of all (query, row) pairs that the bounds between groups leave;
    0 without queries."""
    steps = routed(table, k, every, scale)
    if steps is None:
        return 0.0
    _, queries, groups, _ = steps
    met = queries.select(F.explode("grps").alias("grp")).join(F.broadcast(groups), "grp").agg(F.sum("n")).first()[0] or 0
    return met / (queries.count() * groups.agg(F.sum("n")).first()[0])


def top_inner_products(table: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row of ``table``
    (``vec_id``, ``embedding``) whose id is divisible by ``every``, the ``k`` other
    ids with the largest inner product of the vectors floor(scale * component).

    Null ids, and vectors that are null, empty, not of the commonest length or
    hold null or non-finite components, take no part; rows that repeat id and
    vector count once; a row is no candidate of queries with its id.  Scores must
    fit a long.  Ties go to smaller ids.  Empty tables give no rows."""
    steps = routed(table, k, every, scale)
    if steps is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows, queries, groups, cells = steps
    none = F.lit(None)
    asks = queries.select("own", "share", F.explode("grps").alias("grp"), "vec_id", "vector", "least") \
        .join(F.broadcast(groups), "grp").select(
            "own", "share", "grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "vec_id", "vector",
            none.cast("int").alias("cell"), "least")
    pairs = queries.select("own", "share", F.explode("grps").alias("grp")).distinct()
    copies = rows.join(pairs, "grp").select("own", "share", "grp", "part", "vec_id", "vector", "cell", none.cast("double").alias("least"))

    def solved(t: pa.Table) -> pa.Table:
        asks_ = t.column("least").is_valid().to_numpy()
        ids, x, cell = np.array(t.column("vec_id")), cells.ints(t.column("vector")), t.column("cell").fill_null(-1).to_numpy()
        q_ids, q, least = ids[asks_], x[asks_], t.column("least").to_numpy()[asks_]
        v_ids, v, cell = ids[~asks_], x[~asks_], cell[~asks_]
        out = []
        for at in range(0, len(q) if len(v) else 0, 256):
            some = slice(at, at + 256)
            can = cells.reach(q[some], least[some]).any(axis=0)[cell]
            c_ids = v_ids[can]
            if not len(c_ids):
                continue
            scores = products(q[some], v[can])
            same = q_ids[some, None] == c_ids
            top = best(np.where(same, np.iinfo(np.int64).min + 1, scores), c_ids, k)
            row, column = np.repeat(np.arange(len(top)), top.shape[1]), top.ravel()
            score = scores[row, column]
            ok = ~same[row, column] & (score + 1e-9 * np.abs(score) + 1e-3 >= least[some][row])
            out.append((q_ids[some][row[ok]], c_ids[column[ok]], score[ok]))
        flat = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pa.table({"query_id": pa.array(flat[0], pa.int64()), "vec_id": pa.array(flat[1], pa.int64()), "score": pa.array(flat[2], pa.int64())})
    found = asks.unionByName(copies).groupBy("own", "share", "grp", "part").applyInArrow(solved, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
