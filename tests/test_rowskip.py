"""OFFSET without LIMIT: the rows behind the cut, lazily."""

import random

import pytest

from objectlake import Catalog, ObjectQuery
from objectlake.operators.rowskip import skip_rows

from test_categories import jobs

KEYS = [("a", True, "last"), ("b", False, "first")]


def ordered(rows):
    down = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0]) + [r for r in rows if r[0] is None]
    out = []
    for a in dict.fromkeys(r[0] for r in down):
        same = [r for r in down if r[0] == a]
        out += sorted(same, key=lambda r: (r[1] is not None, r[1] or ""))
    return out


@pytest.mark.parametrize("n", [1, 7, 60, 119, 120, 500])
def test_rows_behind_the_cut(spark, n):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), rnd.choice([1, 2]), [rnd.choice([0, 1])], {"k": rnd.choice([0, 1])}) for _ in range(120)]
    df = spark.createDataFrame(rows, "a int, b string, c int, d array<int>, e map<string,int>").repartition(5)
    got = [tuple(r) for r in skip_rows(df, KEYS, n).collect()]
    want = ordered(rows)[n:]
    assert [r[:2] for r in got] == [r[:2] for r in want]        # ties on the keys are cut by a hash of the row
    left = [repr(r) for r in rows]
    for r in got:
        left.remove(repr(r))
    assert len(left) == min(n, 120)


def test_offset_runs_nothing_when_built(spark):
    cat = Catalog(spark)
    cat.register("Thing", spark.range(1000).selectExpr("id AS Id", "id % 10 AS Size"))
    made = []
    q = ObjectQuery(cat, "Thing").select("Id").order_by(("Size", "desc"), "Id").offset(250)
    assert jobs(spark, lambda: made.append(q.to_df())) == 0
    plan = made[0]._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" in plan
    want = sorted(range(1000), key=lambda i: (-(i % 10), i))[250:]
    assert [r["Id"] for r in made[0].collect()] == want
    assert ObjectQuery(cat, "Thing").select("Id").offset(990).to_df().count() == 10
