"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree (DataFrame functions only).

Each source is a stream of its documents in hash order, cut into blocks of
about ``block_words`` words.  A source's target gives its exact quota of block
draws: every block once a full pass, then blocks in order until the target is
met, the last document taken in part.  The tree splits the quotas of all
sources among the output shards: at a node, the left half's share of each
source is a hypergeometric draw given what is left of the half's room, so each
leaf holds its exact number of draws and sources are spread as if all draws
had been shuffled at once.  A shard gets the next run of each source's
permuted blocks, disjoint from all other shards', and is shuffled locally by a
hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import HASH_RANGE, WORD, hash52, pick, stage

#: words in a block, on average
BLOCK_WORDS = 16_384
#: blocks summed together before the prefix sums over a source
BLOCKS_IN_GROUP = 4_096
WEIGHTS = (3, 1, 2)


def let(body, **values: Column) -> Column:
    """``body`` of a struct of ``values``, each computed once."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), body)[0]


def hypergeometric(total: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``marked`` among ``total`` fall into ``drawn`` draws without
    replacement: inverse transform of the uniform ``u``, walking outwards from
    the mode with the ratios of neighbouring probabilities.  The walk covers
    12 standard deviations each way (all that a double can tell from zero), so
    its length grows with the square root of the counts."""
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def support(v: Column) -> Column:
        low, high = F.greatest(zero, v["drawn"] + v["marked"] - v["total"]), F.least(v["marked"], v["drawn"])
        mode = F.least(high, F.greatest(low, F.floor((v["marked"] + 1.0) * (v["drawn"] + 1.0) / (v["total"] + 2.0)).cast("long")))
        reach = (F.sqrt(F.greatest(F.lit(1.0), v["marked"] * 1.0 * v["drawn"] / F.greatest(one, v["total"]))) * 12 + 12).cast("long")
        return let(lambda x: within(v, x), low=low, high=high, mode=mode, reach=reach)

    def within(v: Column, x: Column) -> Column:
        def up(k: Column) -> Column:     # p(k) / p(k - 1)
            return (v["marked"] - k + 1.0) * (v["drawn"] - k + 1.0) / (k * (v["total"] - v["marked"] - v["drawn"] + k + 0.0))

        def down(k: Column) -> Column:   # p(k) / p(k + 1)
            return (k + 1.0) * (v["total"] - v["marked"] - v["drawn"] + k + 1.0) / ((v["marked"] - k) * (v["drawn"] - k + 0.0))
        ups = steps(x["mode"] + 1, F.least(x["high"], x["mode"] + x["reach"]), 1)
        downs = steps(x["mode"] - 1, F.greatest(x["low"], x["mode"] - x["reach"]), -1)
        drawn_at = let(lambda y: let(
            lambda g: F.when(g["goal"] < 1.0, x["mode"])
            .when(g["goal"] < 1.0 + y["above"], walk(y["ups"], up, g["goal"], F.lit(1.0)))
            .otherwise(walk(y["downs"], down, g["goal"], 1.0 + y["above"])),
            goal=v["u"] * (y["above"] + mass(y["downs"], down) + 1.0)),
            ups=ups, downs=downs, above=mass(ups, up))
        return F.when(x["low"] >= x["high"], x["low"]).otherwise(drawn_at)

    def steps(start: Column, end: Column, by: int) -> Column:
        some = start <= end if by > 0 else start >= end
        return F.when(some, F.sequence(start, end, F.lit(by).cast("long"))).otherwise(F.array().cast("array<bigint>"))

    def mass(seq: Column, ratio) -> Column:
        begin = F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"))
        return F.aggregate(seq, begin, lambda a, k: let(
            lambda r: F.struct(r["w"].alias("w"), (a["sum"] + r["w"]).alias("sum")), w=a["w"] * ratio(k)))["sum"]

    def walk(seq: Column, ratio, goal: Column, begun: Column) -> Column:
        """The first value whose sum of masses passes ``goal``, else the last one."""
        begin = F.struct(F.lit(1.0).alias("w"), begun.alias("sum"), F.lit(False).alias("found"), zero.alias("at"))
        return F.aggregate(seq, begin, lambda a, k: F.when(a["found"], a).otherwise(let(
            lambda r: F.struct(r["w"].alias("w"), (a["sum"] + r["w"]).alias("sum"),
                               (a["sum"] + r["w"] > goal).alias("found"), k.alias("at")), w=a["w"] * ratio(k))))["at"]

    return let(support, total=total.cast("long"), marked=marked.cast("long"), drawn=drawn.cast("long"), u=u)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """``quotas`` (``source_no``, ``draws``) split among ``shards`` shards of
    room equal up to one: rows (``source_no``, ``until``), ``until[i]`` being
    how many of the source's draws shards 0 to i hold.  One row a tree node
    holds a number for each source; there is no row of a document here."""
    node = quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", "draws"))).alias("all")).select(
        F.lit(0).alias("lo"), F.transform("all", lambda x: x["draws"]).alias("q"),
        F.transform("all", lambda x: x["source_no"]).alias("names"),
        F.aggregate("all", F.lit(0).cast("long"), lambda a, x: a + x["draws"]).alias("total"))
    width = 2 ** max(0, math.ceil(math.log2(shards)))

    def room(lo: Column, n: int) -> Column:    # of shards lo to lo + n - 1, as far as they exist
        have = F.greatest(F.lit(0), F.least(F.lit(n), F.lit(shards) - lo)).cast("long")
        extra = F.col("total") % shards
        return have * F.floor(F.col("total") / shards) + F.greatest(F.lit(0), F.least(have, extra - lo))

    while width > 1:
        half = width // 2
        level = F.lit(width)
        left_room = room(F.col("lo"), half)

        def place(acc: Column, i: Column) -> Column:
            u = (F.pmod(F.xxhash64(F.lit(seed), level, F.col("lo"), i), F.lit(2 ** 52)) + F.lit(0.5)) / F.lit(HASH_RANGE)
            k = F.element_at("q", i)
            return let(lambda v: F.struct((acc["n"] - v["k"]).alias("n"), (acc["room"] - v["x"]).alias("room"),
                                          F.concat(acc["x"], F.array(v["x"])).alias("x")),
                       k=k, x=hypergeometric(acc["n"], k, acc["room"], u))

        start = F.struct(F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"),
                         left_room.cast("long").alias("room"), F.array().cast("array<bigint>").alias("x"))
        index = F.when(F.size("q") > 0, F.sequence(F.lit(1), F.size("q"))).otherwise(F.array().cast("array<int>"))
        # a table at each level, so that the next level's expressions don't repeat this level's draws
        drawn = stage(node.withColumn("left", F.aggregate(index, start, place)["x"]), "mix-tree")
        rest = F.zip_with("q", "left", lambda a, b: a - b)
        node = drawn.select(F.explode(F.array(
            F.struct("lo", F.col("left").alias("q"), "names", "total"),
            F.struct((F.col("lo") + half).alias("lo"), rest.alias("q"), "names", "total"))).alias("n")).select("n.*")
        width = half
    held = node.where(F.col("lo") < shards).select(
        F.col("lo").alias("shard"), F.explode(F.arrays_zip("names", "q")).alias("x")).select(
        "shard", F.col("x.names").alias("source_no"), F.col("x.q").alias("n"))
    until = F.sum("n").over(Window.partitionBy("source_no").orderBy("shard"))
    held = held.select("source_no", F.struct("shard", until.alias("until")).alias("x"))
    return held.groupBy("source_no").agg(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["until"]).alias("until"))


def plan_sources(sized: DataFrame, weights: tuple[int, ...], budget: float, cap: float) -> DataFrame:
    """A row per source: words, weight and target.  Targets share ``budget``
    times all words by weight and stop at ``cap`` times the source's words;
    sources sorted by where they reach their cap, the share per weight that
    fits is the largest of the shares left after capping 0, 1, 2, ... of them."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(sources, "mix-sources")
    no = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(no - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = sources.select("source", "source_size", no.alias("source_no"), weight.alias("weight"),
                             (F.col("source_size") * cap).alias("most"))
    by_cap = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source_no"))
    everything = Window.partitionBy()
    used = F.coalesce(F.sum("most").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    share = (F.sum("source_size").over(everything) * budget - used) / left
    sources = sources.withColumn("share", share)
    target = F.least(F.col("most"), F.max("share").over(everything) * F.col("weight"))
    return sources.select("source", "source_size", "source_no", target.alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = 1.5, cap: float = 2.0,
        shards: int = 16, seed: int = 17, block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``, ``source``): ``size``
    (words; null text 0), ``source_size``, ``target`` and ``draws``, an array of
    (pass_no, shard, words, place): the words that each draw takes (all of the
    document, or at the end of a source's quota its first ones) and its place
    in the shard's local shuffle.  ``keep`` carries further columns of ``docs``.

    A null source is a source of its own, last in order.  Documents without
    words are never drawn.  Rows that repeat an id are drawn each on its own;
    rows without an id are told apart by where they are read.  Empty tables
    give no rows.  The draws depend on ids, sizes and ``seed`` alone, so reruns
    agree."""
    rows = pick(docs, *dict.fromkeys(("doc_id", "text", "source", *keep))).withColumn("address", F.monotonically_increasing_id())
    mark = F.when(F.col("doc_id").isNull(), F.concat(F.lit("row "), F.col("address").cast("string"))) \
        .otherwise(F.col("doc_id").cast("string"))
    sized = stage(rows.select(
        "doc_id", "source", *[c for c in keep if c not in ("doc_id", "source")], "address",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash52(F.lit(seed), mark).alias("h")), "mix-docs")
    words = F.round("target").cast("long")
    sources = plan_sources(sized, weights, budget, cap).withColumn("words", words) \
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("words") / F.col("source_size"))).otherwise(0)) \
        .withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size")) \
        .withColumn("n_blocks", F.ceil(F.greatest(F.lit(1), F.col("source_size")) / F.lit(float(block_words))))
    sources = stage(sources, "mix-plan")

    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    block = F.least(F.col("n_blocks") - 1, F.floor(F.col("h") / F.lit(HASH_RANGE) * F.col("n_blocks")))
    placed = sized.alias("d").join(sources.alias("s"), same).select(
        "d.*", "s.source_no", "s.source_size", "s.target", "s.passes", "s.rest", "s.n_blocks", block.alias("block"))
    # the block in which a source's last pass ends, by prefix sums over groups of blocks, then over blocks
    blocks = placed.where("rest > 0").groupBy("source_no", "rest", "block").agg(F.sum("size").alias("w")) \
        .withColumn("grp", F.floor(F.col("block") / BLOCKS_IN_GROUP))
    blocks = stage(blocks, "mix-blocks")

    def prefix(*keys: str) -> Column:
        order = "block" if "grp" in keys else "grp"
        return F.coalesce(F.sum("w").over(Window.partitionBy(*keys).orderBy(order)
                                          .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = blocks.groupBy("source_no", "grp").agg(F.sum("w").alias("w"))
    groups = groups.select("source_no", "grp", prefix("source_no").alias("begun"))
    ends = blocks.join(groups, ["source_no", "grp"]).withColumn("begun", F.col("begun") + prefix("source_no", "grp"))
    ends = ends.where("begun < rest and rest <= begun + w").select(
        "source_no", F.col("block").alias("end_block"), (F.col("rest") - F.col("begun")).alias("end_words"))
    quotas = sources.join(ends, "source_no", "left")
    draws = F.col("passes") * F.col("n_blocks") + F.coalesce(F.col("end_block") + 1, F.lit(0))
    quotas = stage(quotas.select("source_no", "source", "source_size", "target", "passes", "n_blocks", "end_block",
                                 "end_words", draws.cast("long").alias("draws")), "mix-quotas")
    runs = stage(split_quotas(quotas.select("source_no", "draws"), shards, seed), "mix-runs")
    quotas = stage(quotas.join(runs, "source_no"), "mix-shares")

    placed = sized.alias("d").join(quotas.alias("s"), same).select("d.*", *[f"s.{c}" for c in quotas.columns if c != "source"]) \
        .withColumn("block", block)
    # only the documents of the end blocks are put in order
    at_end = (F.col("block") == F.col("end_block")) & (F.col("size") > 0)
    in_order = Window.partitionBy("source_no").orderBy("h", "doc_id", "size", "address").rowsBetween(Window.unboundedPreceding, -1)
    ended = placed.where(at_end).withColumn("begun", F.coalesce(F.sum("size").over(in_order), F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("end_words") - F.col("begun")))
    others = placed.where(~F.coalesce(at_end, F.lit(False)))
    whole = F.when(F.col("block") < F.col("end_block"), F.col("size")).otherwise(0)
    rows = ended.withColumn("part", part).drop("begun").unionByName(others.withColumn("part", whole))

    def drawn(no: Column, taken: Column) -> Column:
        at = no * F.col("n_blocks") + F.col("block")
        shard = F.size(F.filter("until", lambda x: x <= at))
        return F.struct(no.cast("int").alias("pass_no"), shard.alias("shard"), taken.cast("long").alias("words"),
                        F.xxhash64(F.lit(seed), shard, "h", no.cast("int")).alias("place"))
    full = F.transform(F.when(F.col("passes") > 0, F.sequence(F.lit(0).cast("long"), F.col("passes") - 1))
                       .otherwise(F.array().cast("array<bigint>")), lambda p: drawn(p, F.col("size")))
    last = F.when(F.col("part") > 0, F.array(drawn(F.col("passes"), F.col("part")))).otherwise(F.array())
    draws = F.filter(F.concat(full, last), lambda d: d["words"] > 0)
    return rows.select("doc_id", *[c for c in dict.fromkeys(("source", *keep)) if c != "doc_id"], "size",
                       "source_size", "target", draws.alias("draws"))


def dealt(mixed: DataFrame, *columns: str) -> DataFrame:
    """A row per draw of ``mixed`` (what ``mix`` returns): ``columns``, ``size``,
    and the draw's ``pass_no``, ``shard``, ``words`` and ``place``."""
    one = mixed.select(*columns, "size", F.explode("draws").alias("draw"))
    return one.select(*columns, "size", *[F.col(f"draw.{c}").alias(c) for c in ("pass_no", "shard", "words", "place")])


def taken_words(mixed: DataFrame) -> Column:
    """The words that all draws of a document take."""
    return F.aggregate(mixed["draws"], F.lit(0).cast("long"), lambda a, d: a + d["words"])
