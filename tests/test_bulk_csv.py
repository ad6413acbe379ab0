"""Bulk CSV files cut between tasks, and columns by each file's own header."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake.sources import bulkcsv

SCHEMA = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Note", T.StringType()), T.StructField("Size", T.IntegerType())])


def written(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, quoting=csv.QUOTE_ALL, lineterminator="\r\n")
        out.writerow(header)
        out.writerows(rows)


@pytest.fixture
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda size: [spark.conf.set(k, v) for k, v in zip(old, (size, "1"))]
    for k, v in old.items():
        spark.conf.set(k, v)


def notes(rnd, n):
    return [(i, "".join(rnd.choice('ab,"\n\r\n é🙂') for _ in range(rnd.choice([0, 3, 30, 400]))), i % 100) for i in range(n)]


def kept(rows):
    return sorted((i, note or None, size) for i, note, size in rows)


@pytest.mark.parametrize("block,chunk", [("128m", 4 << 20), ("3k", 4 << 20), ("700", 300), ("64", 50)])
def test_records_are_cut_at_their_ends(spark, tmp_path, monkeypatch, small_blocks, block, chunk):
    monkeypatch.setattr(bulkcsv, "CHUNK", chunk)
    rnd = random.Random(block)
    rows = notes(rnd, 250 if block != "64" else 40)
    written(tmp_path / "a.csv", ["Id", "Note", "Size"], rows)
    more = [(1000 + i, n, s) for i, n, s in notes(rnd, 20)]
    written(tmp_path / "b.csv", ["SIZE", "Other", "note", "id"], [(s, "x\n\"", n, i) for i, n, s in more])     # swapped, one more
    written(tmp_path / "c.csv", ["Note", "Id"], [("only\ntwo", 5000)])
    small_blocks(block)
    got = bulkcsv.read_bulk_results(spark, str(tmp_path), SCHEMA).collect()
    assert sorted(map(tuple, got)) == sorted(kept(rows + more) + [(5000, "only\ntwo", None)])


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_blocks):
    rows = [(i, f"line one of {i}\nline two, \"quoted\"\n" + "text " * 200, i % 7) for i in range(8000)]
    written(tmp_path / "big.csv", ["Id", "Note", "Size"], rows)
    assert os.path.getsize(tmp_path / "big.csv") > 8 << 20
    small_blocks("2m")
    found = bulkcsv.read_bulk_results(spark, str(tmp_path), SCHEMA)
    parts = found.groupBy(F.spark_partition_id()).count().collect()
    assert len([r for r in parts if r["count"] > 100]) >= 4
    assert sorted(map(tuple, found.collect())) == kept(rows)


def test_files_that_are_refused(spark, tmp_path):
    written(tmp_path / "a.csv", ["Id", "Note"], [(1, "x"), (2, "y", "z")])
    with pytest.raises(Exception, match="3 values, its header 2"):
        bulkcsv.read_bulk_results(spark, str(tmp_path / "a.csv"), SCHEMA).collect()
    (tmp_path / "blank.csv").write_text("\n\n")
    with pytest.raises(Exception, match="no header"):
        bulkcsv.read_bulk_results(spark, str(tmp_path / "blank.csv"), SCHEMA)


def test_record_ends():
    text = 'a,"b\nc"\r\n"d ""e\n"" f"\nx\n'
    out = bulkcsv.record_ends(text, False)
    assert [text.encode()[a:b].decode() for a, b in zip([0, *out], out)] == ['a,"b\nc"\r\n', '"d ""e\n"" f"\n', "x\n"]
    assert list(csv.reader(io.StringIO(text, newline="")))[1] == ['d "e\n" f']
    assert text.encode()[:bulkcsv.record_ends('b\nc"\n', True)[0]] and bulkcsv.record_ends('b\nc"\n', True).tolist() == [5]
