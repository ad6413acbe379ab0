"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

The tree has regions, racks in a region and shards in a rack.  A row descends
it: at each node every child gets the draw ``ln(u) / weight`` with ``u`` a hash
of the key and the child's name, and the largest draw wins (weighted
rendezvous), so a child wins in proportion to its weight, the total weight
below it.  When weights change, a row changes its choice at a node only in
favour of a child that became heavier or away from one that became lighter:
movement stays inside subtrees whose weights changed.

``grow`` adds a shard as a region of its own, so that the weights of all
earlier subtrees stay and rows move into the new shard only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HASH_RANGE, hash52, pick, stage


@dataclass(frozen=True)
class Topology:
    """``regions``: for each region its racks, for each rack its ``(shard,
    weight)`` pairs.  Names of nodes come from their positions, so a node
    keeps its draws when others are added after it."""

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @staticmethod
    def even(shards: int, per_rack: int = 2, racks: int = 2) -> Topology:
        """``shards`` shards of weight 1, filled rack by rack."""
        ids = [(s, 1.0) for s in range(shards)]
        rack_list = [tuple(ids[i:i + per_rack]) for i in range(0, shards, per_rack)]
        return Topology(tuple(tuple(rack_list[i:i + racks]) for i in range(0, len(rack_list), racks)))

    def grow(self, shard: int, weight: float = 1.0) -> Topology:
        """One more shard, in a new region."""
        return Topology(self.regions + ((((shard, weight),),),))

    def children(self) -> dict[str, list[tuple[str, float, int]]]:
        """Node name -> (child name, weight below it, its shard or -1)."""
        out: dict[str, list[tuple[str, float, int]]] = {"t": []}
        for r, racks in enumerate(self.regions):
            region, out[f"r{r}"] = f"r{r}", []
            for k, shards in enumerate(racks):
                rack = f"{region}k{k}"
                out[rack] = [(f"{rack}s{s}", w, s) for s, w in shards if w > 0]
                out[region].append((rack, sum(w for _, w in shards), -1))
            out["t"].append((region, sum(c[1] for c in out[region]), -1))
        return {n: [c for c in cs if c[1] > 0] for n, cs in out.items()}


def shard_of(key: Column, topology: Topology) -> Column:
    """The shard of ``key``: three weighted draws, one for each level.  Only
    the children of the chosen node are drawn, so a row costs the sum of the
    three fan-outs, not the number of shards.  A null key counts as the text
    ``null``."""
    kids = topology.children()
    if not kids["t"]:
        raise ValueError("the topology has no shard of positive weight")
    table = F.create_map(*[x for n, cs in kids.items() if cs for x in (
        F.lit(n), F.array(*[F.struct(F.lit(c).alias("name"), F.lit(float(w)).alias("w"), F.lit(s).alias("shard"))
                            for c, w, s in cs]))])

    def descend(node: Column) -> Column:
        best = F.array_max(F.transform(F.element_at(table, node), lambda c: F.struct(
            (F.ln((hash52(key, c["name"]) + F.lit(0.5)) / F.lit(HASH_RANGE)) / c["w"]).alias("draw"),
            c["name"].alias("name"), c["shard"].alias("shard"))))
        return best
    region = descend(F.lit("t"))["name"]
    rack = descend(region)["name"]
    return descend(rack)["shard"]


def number_slots(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with ``slot``: 0, 1, ... within each ``shard``, by ``order``.

    No shard is gathered in one task: rows are range-partitioned and sorted by
    (shard, order, address), so that even equal rows are split, and each
    range's first number comes from the counts of ranges and shards, a table
    of a few rows a partition."""
    addressed = stage(df.withColumn("address_", F.monotonically_increasing_id()), "slots-in")
    keys = ["shard", *order, "address_"]
    ranged = stage(addressed.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("line_", F.monotonically_increasing_id()), "slots-ranged")
    ranged = ranged.withColumn("part_", F.shiftright("line_", 33))
    starts = ranged.groupBy("part_", "shard").agg(F.count(F.lit(1)).alias("n_"), F.min("line_").alias("first_"))
    before = F.coalesce(F.sum("n_").over(Window.partitionBy("shard").orderBy("part_")
                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = stage(starts.select("part_", "shard", (before - F.col("first_")).alias("shift_")), "slots-starts")
    return (ranged.join(starts, ["part_", "shard"])
            .withColumn("slot", F.col("line_") + F.col("shift_"))
            .drop("part_", "line_", "shift_", "address_"))


def shard_documents(docs: DataFrame, topology: Topology, grown: Topology | None = None) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): size (UTF-8 bytes
    of the text, null 0, plus 1), unsigned CRC-32 of the text (null as empty),
    shard, gapless slot in the shard, and the shard under ``grown``.

    Law ``key``: the id and the tree alone decide, so repeated rows and rows
    with null ids share a shard; slots follow a hash of the id, then id, size
    and CRC.  An empty table gives an empty result; other columns are ignored."""
    key = F.col("doc_id").cast("string")
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("text_crc32"),
        shard_of(key, topology).alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        hash52(F.lit("slot"), key).alias("place_"))
    out = number_slots(rows, ["place_", "doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
