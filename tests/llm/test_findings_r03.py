"""What the findings of round 3 asked for."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from objectlake.llm import components, similarity


def counted(monkeypatch, module):
    """The names of the tables that ``module`` writes from now on."""
    names, stage = [], module.stage

    def watched(df, name):
        names.append(name)
        return stage(df, name)
    monkeypatch.setattr(module, "stage", watched)
    return names


# -- op5: few written tables -------------------------------------------------------------
def test_stars_are_written_once(spark, monkeypatch):
    written = counted(monkeypatch, components)
    edges = [(i, i % 7) for i in range(7, 300)] * 2 + [(900, 900)]
    roots = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(roots) == 300 and {(r["node"], r["root"]) for r in roots} == {(i, i % 7) for i in range(300)}
    assert len(written) == 1


@pytest.mark.parametrize("part", [100_000, 16])
def test_long_paths_settle_in_few_tables(spark, monkeypatch, part):
    monkeypatch.setattr(components, "EDGES_IN_PART", part)
    written = counted(monkeypatch, components)
    rnd = random.Random(8)
    order = list(range(512))
    rnd.shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, 1000 + i) for i in range(1, 40)] + [(3000, 2000 + i) for i in range(40)]
    roots = components.components(spark.createDataFrame(edges * 2, "a long, b long")).collect()
    want = {(i, 0) for i in range(512)} | {(1000 + i, 1000) for i in range(40)} | {(2000 + i, 2000) for i in range(40)} | {(3000, 2000)}
    assert len(roots) == len(want) and {(r["node"], r["root"]) for r in roots} == want
    assert len(written) <= 9


def test_no_edges(spark):
    for edges in ([], [(5, 5)]):
        assert components.components(spark.createDataFrame(edges, "a long, b long")).collect() == []


# -- op5: a task's groups in one stream --------------------------------------------------
@pytest.mark.parametrize("batch", [3, 10_000])
def test_groups_in_one_stream(spark, batch):
    def summed(table):
        n = table.column("n").to_pylist()
        return pa.table({"a": table.column("a")[:1], "b": table.column("b")[:1], "n": pa.array([sum(n)], pa.int64()), "rows": pa.array([len(n)], pa.int64())})
    rnd = random.Random(9)
    rows = [(rnd.randint(-9, 9), rnd.randint(0, 2), rnd.randint(0, 99)) for _ in range(400)] + [(77, 1, 1)] * 50
    table = spark.createDataFrame(rows, "a long, b int, n long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = [tuple(r) for r in similarity.group_by_group(table, ["a", "b"], summed, "a long, b int, n long, rows long").collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    want = [tuple(r) for r in table.groupBy("a", "b").agg(F.sum("n"), F.count("n")).collect()]
    assert sorted(got) == sorted(want)


def test_prefix_cells_are_written_once(spark, monkeypatch):
    written = counted(monkeypatch, similarity)
    texts = [" ".join(f"w{i}" if i != k else "other" for i in range(60)) for k in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["component_id"] for r in similarity.jaccard_components(docs, 4, 70).collect()} == {0}
    assert "cells" in written and "shared" not in written
