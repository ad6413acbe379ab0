"""Versioned table folders, and merges that rewrite only the files they touch."""

import os

import pytest
from pyspark.sql import functions as F

from objectlake import Catalog
from objectlake.catalog import CatalogError
from objectlake.sinks import merge as M
from objectlake.sinks import versions as V
from objectlake.sinks.write import apply_write


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def hundred_files(spark, path, n=20_000):
    table = spark.range(n).select(F.col("id").alias("Id"), (F.col("id") % 7).alias("Size"), F.concat(F.lit("n"), "id").alias("Name"))
    table.repartitionByRange(100, "Id").write.parquet(path)
    return spark.read.parquet(path)


def test_ten_keys_leave_the_other_files(spark, tmp_path):
    path = str(tmp_path / "table")
    before = hundred_files(spark, path)
    names = set(V.snapshot(spark, path).files)
    assert len(names) == 100
    inp = spark.createDataFrame([(i, 100 + i) for i in (5, 6, 7, 10_001, 10_002, 19_999, 20_000, 20_001, 30_000, -4)], "Id long, Size long")
    want = rows_of(apply_write(before, inp, "upsert", "Id").table)
    done = M.merge(spark, path, inp, "upsert")
    after = V.snapshot(spark, path)
    assert len(done.rewritten) == 3 and done.untouched == 97 and done.version == after.version == 1
    assert set(after.files) >= names - set(done.rewritten) and not set(after.files) & set(done.rewritten)
    assert rows_of(V.read_table(spark, path)) == want


def test_scattered_keys_are_found_by_the_filters(spark, tmp_path):
    """Files whose key ranges all overlap: ranges rule nothing out, the filters do."""
    path = str(tmp_path / "table")
    spark.range(0, 400_000, 2).select(F.col("id").alias("Id"), F.lit("x").alias("Name")).repartition(60, "Id").write.parquet(path)
    snap = V.snapshot(spark, path)
    files, bits = M._summary(spark, snap, "Id", spark.read.parquet(path).schema)
    keys = spark.createDataFrame([(i,) for i in (10, 5_000, 399_998)], "key long")
    may = {r["file"] for r in M.files_that_may_hold(spark, files, bits, keys).collect()}
    held = set(M.touched_files(spark, snap, keys, "Id", spark.read.parquet(path).schema))
    assert held <= may and len(held) <= 3 and len(may) <= 12
    absent = spark.range(1, 400_000, 1000).select(F.col("id").alias("key")).where("key % 2 = 1")
    hits = bits.join(absent.select("key", F.explode(F.array(*[F.lit(r["words"]) for r in files.select("words").distinct().collect()])).alias("words"))
                     .select("key", "words", M._word(F.col("key"), F.col("words")).alias("word"), M._mask(F.col("key")).alias("mask")), ["words", "word"]) \
        .where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask")).count()
    assert hits < 0.03 * absent.count() * 60        # absent keys that the filters let through


@pytest.mark.parametrize("operation", ["update", "upsert"])
def test_merge_is_apply_write(spark, tmp_path, operation):
    path = str(tmp_path / "table")
    before = hundred_files(spark, path, 3000)
    inp = spark.createDataFrame([(1, 9, "a"), (1, 8, "b"), (2, None, "c"), (None, 1, "d"), (5000, 2, "e"), (2999, 3, None)], "ID long, size long, NAME string")
    want = apply_write(before, inp, operation, "Id")
    table, refused = rows_of(want.table), rows_of(want.rejected)
    done = M.merge(spark, path, inp, operation, on_error="skip")
    assert rows_of(V.read_table(spark, path)) == table and rows_of(done.rejected) == refused
    again = M.merge(spark, path, spark.createDataFrame([(7, 70)], "Id long, Size long"), operation)
    assert again.version == 2 and len(again.rewritten) == 1
    assert V.read_table(spark, path).where("Id = 7").first()["Size"] == 70
    assert V.read_table(spark, path).count() == len(table)


def test_text_keys_and_many_keys(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(2000).select(F.concat(F.lit("k"), "id").alias("Code"), "id").repartition(8).write.parquet(path)
    inp = spark.range(500).select(F.concat(F.lit("k"), F.col("id") * 5).alias("Code"), F.lit(-1).cast("long").alias("id"))
    want = rows_of(apply_write(spark.read.parquet(path), inp, "upsert", "Code").table)
    M.merge(spark, path, inp, "upsert", key="code")
    assert rows_of(V.read_table(spark, path)) == want


def test_rejected_rows_stop_or_leave(spark, tmp_path):
    path = str(tmp_path / "table")
    hundred_files(spark, path, 200)
    bad = spark.createDataFrame([(1, 5), (900, 5)], "Id long, Size long")
    with pytest.raises(CatalogError, match="does not exist"):
        M.merge(spark, path, bad, "update")
    assert not V.is_versioned(spark, path)
    none = M.merge(spark, path, spark.createDataFrame([(900, 5)], "Id long, Size long"), "update", on_error="skip")
    assert none.version == 0 and none.added == [] and none.rejected.count() == 1
    assert M.merge(spark, path, bad, "update", on_error="skip").version == 1
    with pytest.raises(CatalogError, match="do not exist"):
        M.merge(spark, path, spark.createDataFrame([(1, 5)], "Id long, Other long"), "upsert")
    with pytest.raises(CatalogError, match="no table"):
        M.merge(spark, str(tmp_path / "nothing"), bad, "upsert")


def test_a_reader_across_commits_sees_one_version(spark, tmp_path):
    path = str(tmp_path / "table")
    hundred_files(spark, path, 1000)
    cat = Catalog(spark)
    cat.register("Thing", path)
    reader = cat.table("Thing")                         # planned before the commits
    cat.merge("Thing", spark.createDataFrame([(1, 50), (2000, 51)], "Id long, Size long"), "upsert", key="Id")
    between = cat.table("Thing")
    cat.commit("Thing", spark.createDataFrame([(1, 1, "z")], "Id long, Size long, Name string"))
    cat.append("Thing", spark.createDataFrame([(2, "y")], "id long, name string"))
    assert (reader.count(), between.count(), cat.table("Thing").count()) == (1000, 1001, 2)
    assert reader.agg(F.sum("Size")).first()[0] == sum(i % 7 for i in range(1000))
    assert V.expire(spark, path, keep=2) > 0
    assert V.snapshot(spark, path).version == 3 and V.snapshot(spark, path, 2).files
    assert rows_of(cat.table("Thing")) == [(1, 1, "z"), (2, None, "y")]
    V.expire(spark, path)
    kept = [n for folder, _, ns in os.walk(path) for n in ns if n.endswith(".parquet") and "_keys" not in folder]
    assert len(kept) == len(V.snapshot(spark, path).files)
    with pytest.raises(CatalogError, match="no version 1"):
        V.snapshot(spark, path, 1)


def test_the_second_of_two_writers_fails(spark, tmp_path):
    path = str(tmp_path / "table")
    hundred_files(spark, path, 100)
    base = V.snapshot(spark, path)
    V.publish(spark, base, base.files[:50])
    with pytest.raises(CatalogError, match="Another writer"):
        V.publish(spark, base, base.files[50:])
    assert V.snapshot(spark, path).files == base.files[:50]


def test_files_added_by_others_are_summarised(spark, tmp_path):
    path = str(tmp_path / "table")
    hundred_files(spark, path, 500)
    M.merge(spark, path, spark.createDataFrame([(1, 50)], "Id long, Size long"), "update")
    cat = Catalog(spark)
    cat.register("Thing", path)
    cat.append("Thing", spark.createDataFrame([(9000, 1, "new")], "Id long, Size long, Name string"))
    done = cat.merge("Thing", spark.createDataFrame([(9000, 77)], "Id long, Size long"), "update")
    assert len(done.rewritten) == 1 and cat.table("Thing").where("Id = 9000").first()["Size"] == 77


def test_refused_rows_take_three_scans(spark, tmp_path):
    path, more = str(tmp_path / "table"), str(tmp_path / "input")
    spark.range(100).select(F.col("id").alias("Id"), F.lit("x").alias("Name")).write.parquet(path)
    spark.createDataFrame([(1, "a"), (1, "b"), (500, "c"), (None, "d"), (2, "e")], "Id long, Name string").write.parquet(more)
    refused = apply_write(spark.read.parquet(path), spark.read.parquet(more), "update").rejected
    assert rows_of(refused) == sorted([(1, "a", "Duplicate Id in the input"), (1, "b", "Duplicate Id in the input"),
                                       (500, "c", "Id does not exist"), (None, "d", "Id is missing")], key=str)
    plan = refused._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("RelationV2") <= 3, plan
