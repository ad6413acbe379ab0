"""Labels of category trees: paths by pointer jumping, and selectors on them."""

import random

import pytest

from objectlake import Catalog, ObjectQuery
from objectlake.operators.category import category_nodes, tree_paths


def jobs(spark, build):
    """How many jobs ``build`` runs."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        build()
        return len(tracker.getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def paths_of(parent):
    out = {}
    for n in set(parent) | {p for p in parent.values() if p}:
        path = [n]
        while parent.get(path[-1]):
            path.append(parent[path[-1]])
        out[n] = path
    return out


@pytest.mark.parametrize("shape", ["random", "line", "star"])
def test_paths_and_selectors(spark, shape):
    rnd = random.Random(shape)
    n = 150
    parent = {str(i): str({"random": rnd.randrange(i), "line": i - 1, "star": 0}[shape]) for i in range(1, n)}
    parent["other"] = None                      # a tree of one node
    edges = spark.createDataFrame(list(parent.items()) + [("0", "0"), (None, "5")], "child string, parent string")
    labelled = tree_paths(edges)
    want = paths_of(parent)
    assert {r["node"]: r["path"] for r in labelled.collect()} == want
    for names in (["3"], ["7", "149"], ["other", "nothing"]):
        below = {v for v, p in want.items() if set(p) & set(names)}
        above = {a for v in names for a in want.get(v, [])}
        for selector, nodes in (("AT", set(names) & set(want)), ("BELOW", below), ("ABOVE", above), ("ABOVE_OR_BELOW", below | above)):
            got = [r["node"] for r in category_nodes(spark, edges, selector, names, labelled).collect()]
            assert sorted(got) == sorted(nodes)
            if shape == "star" and names == ["3"]:      # the walk of other graphs agrees
                assert sorted(r["node"] for r in category_nodes(spark, edges, selector, names).collect()) == sorted(nodes)


def test_graphs_that_are_no_trees(spark):
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "child string, parent string")
    two = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "b")], "child string, parent string")
    assert tree_paths(ring) is None and tree_paths(two) is None
    assert tree_paths(two.where("false")).count() == 0
    assert tree_paths(spark.createDataFrame([("a", "b"), ("a", "b")], "child string, parent string")).count() == 2


def test_queries_over_a_tree_are_lazy(spark):
    cat = Catalog(spark)
    cat.register("Thing", spark.createDataFrame([(1, "leaf"), (2, "root"), (3, "else"), (4, None)], "Id long, Kind string"))
    cat.register_category_group("Kinds", spark.createDataFrame([("leaf", "mid"), ("mid", "root"), ("else", None)], "child string, parent string"), "Kind", ["Thing"])
    made = {}

    def build():
        for sel in ("AT", "ABOVE", "BELOW", "ABOVE_OR_BELOW"):
            made[sel] = ObjectQuery(cat, "Thing").select("Id").with_category("Kinds", sel, ["mid"]).to_df()
    assert jobs(spark, build) == 0
    assert {sel: sorted(r["Id"] for r in df.collect()) for sel, df in made.items()} == {"AT": [], "ABOVE": [2], "BELOW": [1], "ABOVE_OR_BELOW": [1, 2]}
