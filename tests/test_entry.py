"""Every registered query against its DuckDB oracle at the smoke scale."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from objectlake.sampledata import TABLES, table_path

SMOKE = "/root/testdata/sf0.001"
SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
                 "timestamp": "TIMESTAMP WITH TIME ZONE"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(_norm(r[i])) for i in order) for r in rows))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMOKE, t)}')")
    return c


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["segment", "n", "amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SMOKE)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    rel = con.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    duck = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    for c, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t.upper()) == duck[c], f"{name}.{c}: spark {t} / duckdb {duck[c]}"
    orows = rel.fetchall()
    assert len(rows) == len(orows)
    assert _rows(df.columns, rows) == _rows(rel.columns, orows)


def test_the_rest_works_without_the_subpackage(tmp_path):
    """A copy without the training-data folders and the pipeline, and one with
    the pipeline's module left over, still give all other queries."""
    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "objectlake"), tmp_path / "objectlake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    ask = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e._QUERIES), len(e._QUERIES), sorted(e.oracle_sql()) == sorted(e._SQL))"
    for leftover in (False, True):
        if leftover and os.path.exists(os.path.join(root, "corpus_pipeline.py")):
            shutil.copy(os.path.join(root, "corpus_pipeline.py"), tmp_path)
        told = subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, timeout=120)
        assert told.stdout.split() == ["True", str(len(entry._QUERIES)), "True"], told.stderr
