"""N-gram Jaccard join by count-vector R-trees.

A document is the set of its shingle hashes.  The shingles are hashed into
``GROUPS`` groups, and the counts of the groups are its point; the overlap of
two sets is at most the sum of the smaller of their counts, group by group, and
the overlap of any pair from two boxes of points at most the sum of the smaller
of the boxes' upper corners.  An R-tree over points (or boxes) is joined with
itself from the root down, pairs of boxes whose bound is too small are dropped,
and the pairs of points that are left are verified on the sets.

How it is spread:

1. Equal sets are one node.  Two sets that link share one of their first
   ``n - ceil(t n) + 1`` hashes in any fixed order, so nodes are brought
   together by these (cells); of cells with the same members one is kept.  The
   order is by hash, but hashes that a count finds common come last, so that
   passages that many unlike texts share don't bring them together.
2. In each cell an R-tree join over count vectors alone finds which nodes could
   link.  Large cells are cut into chunks: first each chunk is joined with
   itself, and the components found become boxes; then chunks of the boxes that
   are left are joined pair by pair.  The components over all cells (clusters)
   hold every link.
3. The sets of the nodes in clusters are gathered, cluster by cluster (chunked
   the same way), and the pairs that the bounds leave are verified; a pair
   already joined through others needs no check, so copies don't cost all their
   pairs.

Hashes have 64 bits; sets with equal sums of mixed hashes count as equal.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, pick, stage
from .components import components
from .shingles import HASHED_BYTES, mixed, shingle_sets, text_bytes, word_hashes

#: groups of a set of up to 1023 shingles; twice as many at each doubling of the size, so
#: that unlike sets keep apart: their counts differ by about the root of size times groups
GROUPS = 64
#: hashes that more nodes than this have in their prefixes come last in the order by which
#: prefixes are taken, the most frequent ``MOST_COMMON`` of them (8 bytes each, sent to the tasks)
COMMON, MOST_COMMON = 256, 100_000
#: nodes that are joined with each other in one go
CHUNK = 1024
SET_CHUNK = 512
#: shingles of a set, on average, beyond which fewer sets make a chunk (16 MB of hashes)
SET_SHINGLES = 4096
#: bytes of the corners of box pairs that are compared in one go
PAIR_BYTES = 8 << 20
#: entries (node in a cell) that a task sorts
ENTRIES_IN_PART = 100_000
#: ids up to this many bytes are broadcast to pick texts; beyond it a shuffle join does
BROADCAST_BYTES = 32 << 20

_COUNTS = np.dtype("<u2")


def needed_overlap(a, b, percent: int):
    """The least intersection that links sets of sizes ``a`` and ``b``: 100 i >=
    percent (a + b - i)."""
    return -(-(percent * (a + b)) // (100 + percent))


def group_counts(one: np.ndarray) -> np.ndarray:
    """The set's point.  A group holds the hashes with the same leading bits
    below the first 16, so twice fewer groups are sums of neighbours."""
    groups = GROUPS * max(1, 1 << (len(one).bit_length() - 10)) if len(one) >= 1024 else GROUPS
    shift = np.uint64(48 - (groups.bit_length() - 1))
    place = (mixed(one) & np.uint64((1 << 48) - 1)) >> shift
    counts = np.bincount(place.astype(np.int64), minlength=groups)
    return np.minimum(counts, 65535).astype(_COUNTS)


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(groups, -1).sum(1) if len(counts) > groups else counts


def candidate_pairs(low_n: np.ndarray, high_n: np.ndarray, corners: list[np.ndarray], percent: int):
    """Pairs (i < j) of boxes that may hold a link: an R-tree join at each
    number of groups, between the boxes that have just so many and these or
    finer ones, folded."""
    sizes = np.array([len(c) for c in corners])
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for groups in np.unique(sizes):
        own = sizes == groups
        reach = 100 * high_n[own].max()     # finer boxes beyond it fit none of these
        rows = np.flatnonzero(own | (sizes > groups) & (percent * low_n <= reach))
        if len(rows) < 2:
            continue
        high = np.stack([folded(corners[r].astype(np.int64), int(groups)) for r in rows])
        i, j = rtree_pairs(low_n[rows], high_n[rows], high, percent)
        i, j = rows[i], rows[j]
        now = own[i] | own[j]
        out_i.append(np.minimum(i, j)[now])
        out_j.append(np.maximum(i, j)[now])
    return np.concatenate(out_i), np.concatenate(out_j)


def rtree_pairs(low_n: np.ndarray, high_n: np.ndarray, high: np.ndarray, percent: int, fan: int = 16):
    """Pairs (i < j) of boxes that may hold a link, by an R-tree over them.

    ``low_n`` / ``high_n``: the least and largest set size in each box, ``high``
    its upper corner.  The tree is packed by size, then by the fullest group;
    node pairs are opened level by level while their bound reaches the overlap
    that their smallest sets need and their sizes can fit the threshold."""
    n = len(low_n)
    order = np.lexsort((high.argmax(1), low_n))
    levels = [(low_n[order].astype(np.int64), high_n[order].astype(np.int64), high[order])]
    while len(levels[-1][0]) > fan:
        lo, hi, top = levels[-1]
        cut = np.arange(0, len(lo), fan)
        levels.append((np.minimum.reduceat(lo, cut), np.maximum.reduceat(hi, cut), np.maximum.reduceat(top, cut, axis=0)))

    def opened(depth: int, i: np.ndarray, j: np.ndarray):
        lo, hi, top = levels[depth]
        out_i, out_j = [i[:0]], [j[:0]]
        step = max(1, PAIR_BYTES // (top.shape[1] * top.itemsize))      # wide points, fewer pairs
        for at in range(0, len(i), step):
            a, b = i[at:at + step], j[at:at + step]
            ok = (100 * hi[a] >= percent * lo[b]) & (100 * hi[b] >= percent * lo[a])
            a, b = a[ok], b[ok]
            # sizes that fit the other's range bound the overlap from below
            ok = np.minimum(top[a], top[b]).sum(1) >= needed_overlap(lo[a], lo[b], percent)
            out_i.append(a[ok])
            out_j.append(b[ok])
        return np.concatenate(out_i), np.concatenate(out_j)

    size = len(levels[-1][0])
    i, j = np.triu_indices(size, 1 if len(levels) == 1 else 0)
    i, j = opened(len(levels) - 1, i, j) if len(i) else (i, j)
    for depth in range(len(levels) - 2, -1, -1):
        below = len(levels[depth][0])
        kid = np.arange(fan)
        found = [(i[:0], j[:0])]
        for at in range(0, len(i), 256):    # so many node pairs have 65,536 pairs of children
            x, y = i[at:at + 256, None, None], j[at:at + 256, None, None]
            a = (x * fan + kid[None, :, None] + 0 * kid[None, None, :]).ravel()
            b = (y * fan + kid[None, None, :] + 0 * kid[None, :, None]).ravel()
            ok = (a < below) & (b < below) & ((a < b) if depth == 0 else (a <= b))
            found.append(opened(depth, a[ok], b[ok]))
        i, j = (np.concatenate(x) for x in zip(*found))
    a, b = order[i], order[j]
    return np.minimum(a, b), np.maximum(a, b)


def joined_by(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each of ``n`` items' component under edges (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        np.minimum.at(label, before, label)     # the old root follows
        label = label[label]
        if (label == before).all():
            break
    return label


def describe(docs: DataFrame, k: int, percent: int, common: np.ndarray | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep``, ``node`` (the set's 64-bit name, null without words), ``n``,
    ``counts`` and ``prefix`` (the hashes that make its cells)."""
    def prefix(s: np.ndarray) -> bytes:
        n = len(s) + (-percent * len(s)) // 100 + 1
        if common is not None:
            usual = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
            s = np.concatenate([s[~usual], s[usual]])
        return s[:n].tobytes()

    rows = pick(docs, "doc_id", "text", *keep)

    @lean
    def run(batches):
        for b in chunks(batches, "text", HASHED_BYTES):
            data, offsets = text_bytes(b.column("text"))
            sets = shingle_sets(*word_hashes(data, offsets), k)
            nodes = [int(mixed(s).sum().view(np.int64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays([
                *[b.column(c) for c in ("doc_id", *keep)], pa.array(nodes, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([group_counts(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                pa.array([prefix(s) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", *keep, "node", "n", "counts", "prefix"])
    shape = ", ".join(f"`{c}` {t}" for c, t in rows.select("doc_id", *keep).dtypes)
    return rows.mapInArrow(run, f"{shape}, node long, n long, counts binary, prefix binary")


def shared_cells(nodes: DataFrame, entries: int) -> DataFrame:
    """Of ``nodes`` (``node``, ``prefix``; copies are one): ``hash`` (of the prefixes), ``cell`` (a name of its members), ``members``
    (two or more nodes); of cells with the same members a few."""
    parts = 1 << max(4, math.ceil(math.log2(max(1, entries / ENTRIES_IN_PART))))
    shift = np.uint64(64 - int(math.log2(parts)))
    least_common = COMMON + 1

    @lean
    def packed(batches):
        for b in batches:
            lists = [np.frombuffer(p, np.uint64) for p in b.column("prefix").to_pylist()]
            nodes = b.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            both = np.stack([np.concatenate(lists), np.repeat(nodes, [len(x) for x in lists])], 1) if lists else np.zeros((0, 2), np.uint64)
            both = both[np.argsort(both[:, 0], kind="stable")]
            part = (both[:, 0] >> shift).astype(np.int64)
            at = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays([
                pa.array(part[at], pa.int64()), pa.array([x.tobytes() for x in np.split(both, at[1:])] if len(at) else [], pa.binary())],
                names=["part", "entries"])

    def found(table: pa.Table) -> pa.Table:
        both = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table.column("entries").to_pylist()])
        both = both[np.lexsort((both[:, 1], both[:, 0]))]
        new = np.append(True, (both[1:] != both[:-1]).any(1))
        both = both[new]
        at = np.flatnonzero(np.append(True, both[1:, 0] != both[:-1, 0]))
        count = np.diff(np.append(at, len(both)))
        name = mixed(np.add.reduceat(mixed(both[:, 1]), at) + count.astype(np.uint64))
        many = np.flatnonzero(count > 1)
        _, first = np.unique(name[many], return_index=True)
        kept = count[many] >= least_common      # all common hashes, of the others one for the same members
        kept[first] = True
        many = many[kept]
        return pa.table({"hash": pa.array(both[at[many], 0].view(np.int64)), "cell": pa.array(name[many].view(np.int64)),
                         "members": pa.array([both[a:a + c, 1].tobytes() for a, c in zip(at[many], count[many])], pa.binary())})
    return nodes.select("node", "prefix").mapInArrow(packed, "part long, entries binary").groupBy("part") \
        .applyInArrow(found, "hash long, cell long, members binary")


def common_hashes(nodes: DataFrame) -> np.ndarray:
    """The hashes that more than ``COMMON`` nodes have in their prefixes, the
    most frequent ``MOST_COMMON`` of them, sorted.  Only counts are exchanged,
    summed up in the tasks before, so no hash's nodes meet anywhere."""
    @lean
    def counted(batches):
        for b in batches:
            for part in chunks([b], "prefix"):
                hashes, n = np.unique(np.concatenate([np.frombuffer(p, np.uint64) for p in part.column("prefix").to_pylist()]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], names=["hash", "n"])
    counts = nodes.select("prefix").mapInArrow(counted, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") > COMMON).orderBy(F.desc("n"), "hash").limit(MOST_COMMON).collect()
    return np.sort(np.array([r["hash"] for r in found], np.int64).view(np.uint64))


def group_by_group(rows: DataFrame, keys: list[str], run, shape: str) -> DataFrame:
    """What ``run`` (an Arrow table to another) makes of the rows of each group of ``keys`` (integers, none
    null), as ``applyInArrow`` gives it.  A task's groups come in one stream, sorted by the
    keys: where most groups are a few rows, a stream for each costs more than its rows do."""
    @lean
    def runs(batches):
        held, last = [], None       # the group at the end of the batches so far
        for b in batches:
            if not b.num_rows:
                continue
            key = np.stack([np.array(b.column(k)) for k in keys], 1)
            done = []
            if held and (key[0] != last).any():
                done.append(run(pa.Table.from_batches(held)))
                held = []
            cuts = (np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist()
            for start, end in zip([0, *cuts], [*cuts, b.num_rows]):
                if start:
                    done.append(run(pa.Table.from_batches(held)))
                    held = []
                held.append(b.slice(start, end - start))
            last = key[-1]
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
        if held:
            yield from run(pa.Table.from_batches(held)).to_batches()
    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(runs, shape)


def could_link(cells: DataFrame, boxes: DataFrame, percent: int) -> DataFrame:
    """Edges (``a``, ``b``) that join the members of each cell as the bounds
    would; ``boxes``: ``node``, ``root``, ``n``, ``counts``."""
    @lean
    def unpacked(batches):
        for b in batches:
            lists = [np.frombuffer(m, np.int64) for m in b.column("members").to_pylist()]
            sizes = [len(x) for x in lists]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(b.column("cell").to_numpy(), sizes)), pa.array(np.repeat(np.array(sizes, np.int64), sizes)),
                pa.array(np.concatenate(lists) if lists else np.zeros(0, np.int64))], names=["cell", "size", "node"])
    def members_of(some: DataFrame) -> DataFrame:
        return some.mapInArrow(unpacked, "cell long, size long, node long").join(boxes, "node")

    def joined(table: pa.Table) -> pa.Table:
        low, high, node = (np.array(table.column(c)) for c in ("low_n", "high_n", "node"))
        corners = [np.frombuffer(c, _COUNTS) for c in table.column("counts").to_pylist()]
        label = joined_by(len(node), *candidate_pairs(low, high, corners, percent))
        at = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": pa.array(node[at]), "b": pa.array(node[label[at]])})

    # each chunk with itself
    own = members_of(cells).select("cell", F.pmod(F.xxhash64("cell", "node"), F.ceil(F.col("size") / CHUNK)).alias("chunk"), "node",
                      F.col("n").alias("low_n"), F.col("n").alias("high_n"), "counts")
    first = stage(group_by_group(own, ["cell", "chunk"], joined, "a long, b long"), "could-1")
    # then boxes of what is joined by now, for cells that were cut
    cut = cells.where(F.length("members") > 8 * CHUNK)
    if cut.isEmpty():
        return first
    roots = components(first)
    boxed = members_of(cut).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def box(cells_: np.ndarray, roots_: np.ndarray, low: np.ndarray, high: np.ndarray, counts: list[bytes]) -> pa.Table:
        """One box for each cell and root: the size range and the upper corner, at the coarsest of the groupings."""
        held: dict[tuple[int, int], list] = {}
        for c, r, a, b, raw in zip(cells_.tolist(), roots_.tolist(), low.tolist(), high.tolist(), counts):
            new = np.frombuffer(raw, _COUNTS)
            old = held.get((c, r))
            if old is None:
                held[c, r] = [a, b, new]
            else:
                groups = min(len(new), len(old[2]))
                held[c, r] = [min(a, old[0]), max(b, old[1]), np.maximum(np.minimum(folded(new.astype(np.int64), groups), 65535),
                                                                         np.minimum(folded(old[2].astype(np.int64), groups), 65535)).astype(_COUNTS)]
        return pa.table({"cell": pa.array([k[0] for k in held], pa.int64()), "node": pa.array([k[1] for k in held], pa.int64()),
                         "low_n": pa.array([v[0] for v in held.values()], pa.int64()), "high_n": pa.array([v[1] for v in held.values()], pa.int64()),
                         "counts": pa.array([v[2].tobytes() for v in held.values()], pa.binary())})

    @lean
    def corners(batches):
        for b in batches:
            n = np.array(b.column("n"))
            yield from box(np.array(b.column("cell")), np.array(b.column("root")), n, n, b.column("counts").to_pylist()).to_batches()
    shape = "cell long, node long, low_n long, high_n long, counts binary"
    # corners a batch at a time, then one box a cell and root, and at last chunks of boxes pair by pair
    partial = boxed.select("cell", "root", "n", "counts").mapInArrow(corners, shape)

    def merged(table: pa.Table) -> pa.Table:
        return box(*(np.array(table.column(c)) for c in ("cell", "node", "low_n", "high_n")), table.column("counts").to_pylist())
    full = stage(group_by_group(partial, ["cell", "node"], merged, shape), "cell-boxes")
    sizes = full.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = pair_chunks(full.join(sizes, "cell"), "cell", CHUNK)
    second = stage(group_by_group(pairs, ["cell", "one", "two"], joined, "a long, b long"), "could-2")
    return first.unionByName(second)


def pair_chunks(rows: DataFrame, key: str, chunk: int) -> DataFrame:
    """``rows`` (with ``node`` and the ``size`` of their ``key``), each once for
    every pair of chunks that its own chunk belongs to (``one`` <= ``two``)."""
    n = F.ceil(F.col("size") / chunk).cast("int")
    rows = rows.withColumn("own_", F.pmod(F.xxhash64("node"), n).cast("int"))
    other = F.explode(F.sequence(F.lit(0), n - 1)).alias("other_")
    rows = rows.select("*", other)
    return rows.withColumn("one", F.least("own_", "other_")).withColumn("two", F.greatest("own_", "other_")).drop("own_", "other_")


def verified(sets: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Links (``a``, ``b``) that span the components among the sets of each
    group; ``sets``: the keys, ``node``, ``root`` (what is joined already), ``hashes``."""
    def run(table: pa.Table) -> pa.Table:
        node, once = np.unique(np.array(table.column("node")), return_index=True)
        root = np.array(table.column("root"))[once]
        hashes = [np.frombuffer(h.as_py(), np.uint64) for h in table.column("hashes").take(pa.array(once))]
        n = np.array([len(h) for h in hashes])
        i, j = candidate_pairs(n, n, [group_counts(h) for h in hashes], percent)
        _, label = np.unique(root, return_inverse=True)
        parent = list(range(int(label.max()) + 1)) if len(label) else []

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x
        out = []
        apart = label[i] != label[j]
        for a, b in zip(i[apart].tolist(), j[apart].tolist()):
            x, y = find(int(label[a])), find(int(label[b]))
            if x != y:
                common = len(np.intersect1d(hashes[a], hashes[b], assume_unique=True))
                if 100 * common >= percent * (int(n[a]) + int(n[b]) - common):
                    parent[x] = y
                    out.append((node[a], node[b]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
    return group_by_group(sets, keys, run, "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``,
    ``n_shingles`` and ``component_id``, the smallest id reachable by links (Jaccard
    similarity of the sets of ``k``-word shingles at least ``percent`` per cent).

    Texts of fewer than ``k`` words have one shingle; null texts and texts
    without words none, and link with nothing (their component is their own id).
    Rows that repeat an id stay rows, and equal texts link.  A component
    without any id has a null one.  The whole of a long text counts; an empty
    table gives no rows.  Other columns are ignored."""
    return row_components(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def row_components(docs: DataFrame, k: int, percent: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``jaccard_components``, with the columns ``keep`` of ``docs``
    and ``root``, which names the component by itself, ids or none (null for a
    text that links with nothing for want of words)."""
    described = stage(describe(docs, k, percent, keep=keep), "shingles")
    nodes = stage(described.where("node is not null").groupBy("node").agg(F.min("n").alias("n"), F.min("counts").alias("counts"),
                  F.min("prefix").alias("prefix"), F.min("doc_id").alias("doc_id")), "nodes")
    entries = nodes.agg(F.sum(F.length("prefix") / 8)).first()[0] or 0
    shared = shared_cells(nodes, entries)       # a plan so far
    late = common_hashes(nodes)
    if len(late):
        once = describe(docs, k, percent, late).where("node is not null").groupBy("node").agg(F.min("prefix").alias("prefix"))
        shared = shared_cells(once, entries)
    cells = stage(shared.groupBy("cell").agg(F.first("members").alias("members")), "cells")
    edges = could_link(cells, nodes.select("node", "n", "counts"), percent)
    clusters = components(edges)
    members = clusters.join(nodes, "node").select("node", F.col("root").alias("cluster"), "doc_id", "n")
    members = stage(members.withColumnRenamed("doc_id", "id_"), "members")

    # a chunk has at most SET_CHUNK sets, fewer if these are large
    sizes = members.groupBy("cluster").agg(F.greatest(F.count(F.lit(1)), F.ceil(F.sum("n") / SET_SHINGLES)).alias("size"))
    members = stage(members.drop("n").join(sizes, "cluster"), "cluster-members")

    @lean
    def sets_of(batches):
        for b in chunks(batches, "text", HASHED_BYTES):
            data, offsets = text_bytes(b.column("text"))
            sets = [s for s in shingle_sets(*word_hashes(data, offsets), k) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([int(mixed(s).sum().view(np.int64)) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "hashes"])

    def sets(of: DataFrame) -> DataFrame:
        """The sets of these members, from the texts again."""
        small = of.count() * 8 <= BROADCAST_BYTES
        wanted = of.select(F.col("id_").alias("doc_id")).distinct()
        texts = pick(docs, "doc_id", "text")
        picked = texts.join(F.broadcast(wanted) if small else wanted, "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
        of = of.select("node", "cluster", "size")
        return picked.select("text").mapInArrow(sets_of, "node long, hashes binary").join(F.broadcast(of) if small else of, "node")
    own = sets(members).select("cluster", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SET_CHUNK)).alias("chunk"), "node",
                               F.col("node").alias("root"), "hashes")
    links = stage(verified(own, ["cluster", "chunk"], percent), "links-1")
    large = members.where(F.col("size") > SET_CHUNK)
    if not large.isEmpty():
        roots = components(links)
        large = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = large.groupBy("cluster").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("cluster")
        large = stage(large.join(apart, "cluster", "left_semi"), "large")
        rows = stage(sets(large), "large-sets").join(large.select("node", "root"), "node")
        links = links.unionByName(stage(verified(pair_chunks(rows, "cluster", SET_CHUNK), ["cluster", "one", "two"], percent), "links-2"))
    roots = components(links)
    named = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(smallest, "root").select("node", "root", "component_id")
    out = described.select("doc_id", *keep, "node", F.col("n").alias("n_shingles")).join(named, "node", "left")
    return out.select("doc_id", *keep, "root", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
