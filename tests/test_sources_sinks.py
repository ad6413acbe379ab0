import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake import Catalog, CatalogError, ObjectQuery
from objectlake.operators.chunking import chunk_eligibility, check_chunk_size, key_chunks, read_chunked
from objectlake.operators.packing import global_index, greedy_batches, pack_batches
from objectlake.sinks.csvbatch import check_results, write_csv_batches
from objectlake.sinks.write import apply_write, commit, validate_write, write
from objectlake.sources.bulkcsv import read_bulk_results
from objectlake.sources.multi import select_objects


def _tmp():
    return tempfile.mkdtemp(prefix="objectlake-test-")


def test_bulk_results_files(spark):
    d = _tmp()
    with open(os.path.join(d, "r1.csv"), "w") as f:
        f.write('"Id","IsDeleted","ExpectedRevenue","LastModifiedDate","CloseDate"\r\n'
                '"a1","false","1.5","2019-02-22T07:03:21.000Z","2019-02-22"\r\n'
                '"a2","TRUE","","2019-02-22T07:03:21.123Z","2019-03-01"\r\n')
    with open(os.path.join(d, "r2.csv"), "w") as f:
        f.write('"Id","IsDeleted","ExpectedRevenue","LastModifiedDate","CloseDate"\r\n'
                '"a3","false","2","2020-01-01T00:00:00Z",""\r\n')
    with open(os.path.join(d, "r3.csv"), "w") as f:
        f.write('"Id","IsDeleted","ExpectedRevenue","LastModifiedDate","CloseDate"\r\n')
    schema = T.StructType([T.StructField("Id", T.StringType()), T.StructField("IsDeleted", T.BooleanType()),
                           T.StructField("ExpectedRevenue", T.DoubleType()),
                           T.StructField("LastModifiedDate", T.TimestampType()),
                           T.StructField("CloseDate", T.DateType())])
    rows = {r.Id: r for r in read_bulk_results(spark, d, schema).collect()}
    assert set(rows) == {"a1", "a2", "a3"}
    assert rows["a2"].IsDeleted is True and rows["a2"].ExpectedRevenue is None
    assert rows["a3"].CloseDate is None


def test_bulk_results_quoted_newlines_and_empty_file(spark):
    d = _tmp()
    with open(os.path.join(d, "r.csv"), "w") as f:
        f.write('"Id","ShippingStreet"\r\n"1","line one\nline two"\r\n"2","a, b"\r\n"3","say ""hi"""\r\n"4",""\r\n')
    schema = T.StructType([T.StructField("Id", T.LongType()), T.StructField("ShippingStreet", T.StringType())])
    rows = {r.Id: r.ShippingStreet for r in read_bulk_results(spark, d, schema).collect()}
    assert rows == {1: "line one\nline two", 2: "a, b", 3: 'say "hi"', 4: None}
    e = _tmp()
    open(os.path.join(e, "empty.csv"), "w").close()
    with pytest.raises(CatalogError, match="no header"):
        read_bulk_results(spark, e, schema)


def test_multi_object_rules(cat):
    assert select_objects(cat, "account, vendor") == ["Account", "Vendor"]
    assert "Account" not in select_objects(cat, None, ["Account"])
    with pytest.raises(CatalogError) as e:
        select_objects(cat, "Account,Nope,Other")
    assert len(e.value.failures) == 2
    with pytest.raises(CatalogError):
        select_objects(cat, "Account", "Account")
    multi = cat.objects(allow="Region,Territory")
    schemas = multi.schemas()
    assert set(schemas) == {"multisink.Region", "multisink.Territory"}
    assert "tablename" not in schemas["multisink.Region"].fieldNames()
    assert "tablename" in multi.union().columns


def test_chunking_rules(cat):
    q = ObjectQuery(cat, "Opportunity").select("Id")
    assert chunk_eligibility(q) == []
    assert chunk_eligibility(q.order_by("Id").limit(3))
    assert chunk_eligibility(ObjectQuery(cat, "Territory").select("Id"))        # not chunkable
    assert chunk_eligibility(ObjectQuery(cat, "Territory").select("Id"), parent="Account") == []
    for bad in (0, 250001):
        with pytest.raises(CatalogError):
            check_chunk_size(bad)
    df = cat.table("Opportunity")
    chunks = key_chunks(df, "Id", 2).collect()
    assert sum(r.rows for r in chunks) == df.count()
    with pytest.raises(CatalogError):
        read_chunked(df, "Id", 100, query=q.order_by("Id"))
    assert read_chunked(df, "Id", 100).count() == df.count()


def test_global_index_and_records_packing(cat):
    df = cat.table("Opportunity").select("Id")
    idx = global_index(df, ["Id"], "i").orderBy("Id").collect()
    assert [r.i for r in idx] == list(range(len(idx)))
    packed = pack_batches(df, max_records=100, order_by=["Id"]).orderBy("Id").collect()
    assert [r.batch_id for r in packed] == [i // 100 for i in range(len(packed))]


def test_greedy_byte_packing():
    # header 10 bytes, cap 30: first record checked without header, then header counts
    ids = greedy_batches([15, 5, 5, 25, 40, 1], [0] * 6, header=10, max_records=10, max_bytes=30)
    assert list(ids) == [0, 0, 1, 2, 3, 4]
    assert list(greedy_batches([1] * 5, [0] * 5, header=0, max_records=2, max_bytes=100)) == [0, 0, 1, 1, 2]
    assert list(greedy_batches([1, 1, 1], [0, 20, 5], header=0, max_records=9, max_bytes=25)) == [0, 0, 1]
    with pytest.raises(ValueError, match="larger than the byte limit"):
        greedy_batches([1], [31], header=0, max_records=9, max_bytes=30)


def test_pack_batches_bytes_in_spark(spark):
    df = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(200)], "Id long, Name string")
    out = pack_batches(df, max_records=50, max_bytes=300, order_by=["Id"]).collect()
    sizes = {}
    for r in out:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert len(out) == 200 and max(sizes.values()) <= 50


@pytest.mark.parametrize("max_records,max_bytes", [(50, 300), (1, 300), (7, 100), (10_000, 2_000), (300, 90)])
def test_byte_batches_do_not_depend_on_the_layout(spark, monkeypatch, max_records, max_bytes):
    """The packing of one loop over all rows, whatever the partitions and block sizes."""
    from objectlake.operators import packing
    names = ["x" * (i * 37 % 61) + '"' * (i % 3) for i in range(1200)]
    order = sorted(range(1200), key=lambda i: i * 7919 % 1201)
    rows = [(i * 7919 % 1201, names[i]) for i in order]
    sizes = [len(str(i)) + 2 + 1 + len(n) + n.count('"') + 2 + 2 for i, n in rows]
    header = packing.csv_header_bytes(["Id", "Name"])
    want = list(greedy_batches(sizes, [0] * len(sizes), header, max_records, max_bytes))
    for parts, block, fan in ((2, 1 << 14, 64), (8, 16, 2), (64, 50, 3)):
        monkeypatch.setattr(packing, "BLOCK_ROWS", block)
        monkeypatch.setattr(packing, "FAN", fan)
        df = spark.createDataFrame(rows, "Id long, Name string").repartition(parts)
        got = pack_batches(df, max_records=max_records, max_bytes=max_bytes, order_by=["Id"]).orderBy("Id").collect()
        assert [r["batch_id"] for r in got] == want and [r["Name"] for r in got] == [n for _, n in rows]


def test_byte_packing_with_files_ties_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0), (1, 90), (1, 90), (2, None), (3, 60), (4, 60)], "Id long, Size long")
    got = pack_batches(df, max_records=10, max_bytes=130, order_by=["Id"], file_bytes="Size").orderBy("Id", "batch_id").collect()
    files = {}
    for r in got:
        files[r["batch_id"]] = files.get(r["batch_id"], 0) + (r["Size"] or 0)
    assert len(got) == 6 and max(files.values()) <= 125 and sorted(files) == list(range(len(files)))
    assert pack_batches(df.limit(0), max_records=10, max_bytes=130, order_by=["Id"]).collect() == []
    with pytest.raises(Exception, match="larger than the byte limit"):
        pack_batches(df, max_records=10, max_bytes=80, order_by=["Id"], file_bytes="Size").collect()


def test_only_row_numbers_and_sizes_go_to_python(spark):
    df = spark.createDataFrame([(i, "body" * 9) for i in range(30)], "Id long, Body string")
    plan = pack_batches(df, max_records=10, max_bytes=300, order_by=["Id"])._jdf.queryExecution().optimizedPlan().toString()
    python = [line for line in plan.splitlines() if "InArrow" in line or "InPandas" in line]
    assert python and not any("Body" in line for line in python)


def _target(spark):
    return spark.createDataFrame([(1, "a", 10, 1.0), (2, "b", 20, 2.0), (3, "c", 30, None)],
                                 "Id long, Name string, NumberOfEmployees int, ShippingLatitude double")


def test_validate_write():
    tgt = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Name", T.StringType()),
                        T.StructField("Ext__c", T.StringType()), T.StructField("CreatedDate", T.DateType())])
    inp = T.StructType([T.StructField("name", T.StringType()), T.StructField("CreatedDate", T.DateType()),
                        T.StructField("Bogus", T.StringType())])
    f = validate_write(tgt, inp, "insert", read_only=["CreatedDate"])
    assert len(f) == 2
    assert validate_write(tgt, inp, "upsert", key="Name")     # not an external id, key missing
    assert validate_write(tgt, T.StructType([T.StructField("Ext__c", T.StringType())]), "upsert", key="Ext__c",
                          external_ids=["Ext__c"]) == []
    assert validate_write(tgt, inp, "update")                 # no Id
    assert validate_write(tgt, inp, "merge")
    assert validate_write(tgt, T.StructType([T.StructField("Name", T.IntegerType())]), "insert",
                          check_types=True)


def test_insert_update_upsert(spark):
    tgt = _target(spark)
    ins = spark.createDataFrame([("d", 40)], "NAME string, numberofemployees int")
    t = apply_write(tgt, ins, "insert").table
    assert t.count() == 4 and t.filter("Name = 'd'").first().ShippingLatitude is None
    upd = spark.createDataFrame([(1, None), (3, 33), (9, 1), (2, 5), (2, 6)], "Id long, NumberOfEmployees int")
    res = apply_write(tgt, upd, "update")
    rows = {r.Id: r for r in res.table.collect()}
    assert rows[1].NumberOfEmployees is None and rows[1].Name == "a"       # supplied null sets null
    assert rows[3].NumberOfEmployees == 33 and rows[2].NumberOfEmployees == 20   # duplicates refused
    assert {r.Id: r.error for r in res.rejected.collect()} == {9: "Id does not exist", 2: "Duplicate Id in the input"}
    ups = spark.createDataFrame([(3, "cc"), (None, "new"), (7, "seven")], "Id long, Name string")
    t = {(r.Id, r.Name) for r in apply_write(tgt, ups, "upsert", key="Id").table.collect()}
    assert t == {(1, "a"), (2, "b"), (3, "cc"), (None, "new"), (7, "seven")}


def test_write_error_policy_and_commit(spark):
    cat = Catalog(spark)
    cat.register("Account", _target(spark))
    bad = spark.createDataFrame([(99, "zz")], "Id long, Name string")
    with pytest.raises(CatalogError, match="rejected"):
        write(cat, "Account", bad, "update", on_error="fail")
    res = write(cat, "Account", bad, "update", on_error="skip")
    assert res.rejected.count() == 1
    path = os.path.join(_tmp(), "account")
    commit(res.table, path)
    assert spark.read.parquet(path).count() == 3
    commit(apply_write(res.table, spark.createDataFrame([("e",)], "Name string"), "insert").table, path)
    assert spark.read.parquet(path).count() == 4
    assert sorted(os.listdir(os.path.dirname(path))) == ["account"]


def test_csv_batches_and_results(spark):
    df = spark.createDataFrame([(1, 'say "x"', None, 0), (2, "b", 2.5, 0), (3, "c", 1.0, 1)],
                               "Id long, Name string, Amount double, batch_id long")
    out = os.path.join(_tmp(), "batches")
    write_csv_batches(df, out)
    parts = sorted(p for p in os.listdir(out) if p.startswith("batch_id="))
    assert parts == ["batch_id=0", "batch_id=1"]
    text = "".join(open(os.path.join(out, "batch_id=0", f)).read()
                   for f in os.listdir(os.path.join(out, "batch_id=0")) if f.endswith(".csv"))
    assert text.splitlines()[0] == '"Id","Name","Amount"'
    assert '"1","say ""x""",""' in text
    res = spark.createDataFrame([("1", "true", "true", ""), ("2", "FALSE", "false", "bad value")],
                                "Id string, Success string, Created string, Error string")
    good, bad = check_results(res, "skip")
    assert good.count() == 1 and bad.first().Error == "bad value"
    with pytest.raises(CatalogError, match="bad value"):
        check_results(res, "fail")


def _loop_batches(rec, files, header, max_records, max_bytes):
    out, batch, buf, count, fsum = [], 0, 0, 0, 0
    for b, f in zip(rec, files):
        if count > 0 and (buf + b + fsum + f > max_bytes or count >= max_records):
            batch, buf, count, fsum = batch + 1, 0, 0, 0
        if count == 0:
            buf = header
        buf += b
        count += 1
        fsum += f
        out.append(batch)
    return out


def test_vectorised_packer_matches_row_loop():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from objectlake.operators.packing import GreedyPacker

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.tuples(st.integers(0, 60), st.integers(0, 40)), max_size=80),
           st.integers(0, 30), st.integers(1, 12), st.integers(40, 200), st.integers(1, 5))
    def check(rows, header, max_records, max_bytes, chunks):
        rec = [r[0] for r in rows]
        files = [r[1] for r in rows]
        expected = _loop_batches(rec, files, header, max_records, max_bytes)
        p = GreedyPacker(header, max_records, max_bytes)
        got, step = [], max(1, len(rows) // chunks)
        for i in range(0, len(rows), step):
            got += list(p.feed(rec[i:i + step], files[i:i + step]))
        assert got == expected
    check()


def test_csv_batches_serial(spark):
    df = spark.createDataFrame([(i, f"n{i}", i // 3) for i in range(9)], "Id long, Name string, batch_id long")
    out = os.path.join(_tmp(), "serial")
    write_csv_batches(df, out, serial=True)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 9 and sorted(r.batch_id for r in back.select("batch_id").distinct().collect()) == [0, 1, 2]


def test_catalog_commit_refresh(spark):
    path = os.path.join(_tmp(), "acct")
    _target(spark).write.parquet(path)
    cat = Catalog(spark)
    cat.register("Account", path)
    res = write(cat, "Account", spark.createDataFrame([("z",)], "Name string"), "insert")
    cat.commit("Account", res.table)
    assert cat.table("Account").count() == 4
    cat.register("Mapped", path, {"Key": "Id"})
    with pytest.raises(CatalogError):
        cat.commit("Mapped", cat.table("Mapped"))


def test_scale_settings():
    from objectlake.session import scale_settings
    s = scale_settings(100 * 1024 ** 4, executor_cores_total=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_settings(1 << 20, 16)["spark.sql.shuffle.partitions"]) == 32


def test_multi_object_chunks(cat):
    multi = cat.objects(allow="Account,Opportunity", chunk_size=500)
    u = multi.union()
    assert "chunk_id" in u.columns and u.count() == cat.object("Account").count() + cat.object("Opportunity").count()
    with pytest.raises(CatalogError):
        cat.objects(allow="Territory", chunk_size=10)


def test_check_packing_catches_bad_batches(spark):
    from objectlake.operators.packing import check_packing
    df = spark.createDataFrame([(i, "x" * 5) for i in range(100)], "Id long, Name string")
    good = pack_batches(df, max_records=30, max_bytes=400, order_by=["Id"])
    assert check_packing(good, ["Id", "Name"], "Id", 30, 400).first().violations == 0
    early = df.withColumn("batch_id", (F.col("Id") / 5).cast("long"))          # closed too soon
    assert check_packing(early, ["Id", "Name"], "Id", 30, 400).first().violations > 0
    big = df.withColumn("batch_id", F.lit(0).cast("long"))                       # caps broken
    assert check_packing(big, ["Id", "Name"], "Id", 30, 400).first().violations == 1


def test_update_with_hot_key(spark):
    """A key repeated by a third of the input is refused as a duplicate; the
    duplicate check is a partial (map-side) aggregate, not a window."""
    tgt = spark.range(0, 3000).selectExpr("id AS Id", "CAST(id AS DOUBLE) AS Amount")
    inp = spark.range(0, 3000).selectExpr("CASE WHEN id % 3 = 0 THEN 42 ELSE id END AS Id",
                                          "CAST(-id AS DOUBLE) AS Amount")
    res = apply_write(tgt, inp, "update")
    plan = res.table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_count" in plan
    rows = {r.Id: r.Amount for r in res.table.collect()}
    assert rows[42] == 42.0 and rows[1] == -1.0 and rows[3] == 3.0
    assert res.rejected.filter("Id = 42").count() == 1000   # every multiple of 3 (42 is one)


def test_multi_object_custom_objects(spark):
    cat = Catalog(spark)
    cat.register("IT_Multi_1__c", spark.createDataFrame([("Fred", "DEV"), ("Wilma", "QA")],
                                                        "Name string, Position__c string"), id_field=None)
    cat.register("IT_Multi_2__c", spark.createDataFrame([("Pebbles", "NY")], "Name string, City__c string"),
                 id_field=None)
    rows = sorted(tuple(r) for r in cat.objects(allow="IT_Multi_1__c,IT_Multi_2__c").union()
                  .select("tablename", "Name", "Position__c", "City__c").collect())
    assert rows == [("IT_Multi_1__c", "Fred", "DEV", None), ("IT_Multi_1__c", "Wilma", "QA", None),
                    ("IT_Multi_2__c", "Pebbles", None, "NY")]
    assert cat.get("IT_Multi_1__c").custom


def test_error_policy_texts():
    from objectlake.sinks.write import error_policy
    assert error_policy("Skip on error") == "skip" and error_policy("FAIL ON ERROR") == "fail"
    with pytest.raises(CatalogError):
        error_policy("ignore")


def test_write_batched(spark):
    from objectlake.sinks.csvbatch import write_batched
    df = spark.createDataFrame([(i, f"name {i}") for i in range(50)], "Id long, Name string")
    out = os.path.join(_tmp(), "batched")
    write_batched(df, out, order_by=["Id"], max_records=20)
    parts = sorted(p for p in os.listdir(out) if p.startswith("batch_id="))
    assert parts == ["batch_id=0", "batch_id=1", "batch_id=2"]
    schema = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Name", T.StringType())])
    back = read_bulk_results(spark, out, schema)
    assert back.count() == 50 and back.filter("Name = 'name 7'").count() == 1


def test_commit_partitioned(spark):
    path = os.path.join(_tmp(), "parts")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "Id long, Seg string")
    commit(df, path, partition_by="Seg")
    assert sorted(p for p in os.listdir(path) if p.startswith("Seg=")) == ["Seg=a", "Seg=b"]
    back = spark.read.parquet(path).filter("Seg = 'a'")
    assert back.count() == 2 and "PartitionFilters: [isnotnull(Seg" in back._jdf.queryExecution().executedPlan().toString()


def test_commit_aborts_cleanly(spark):
    base = _tmp()
    path = os.path.join(base, "t")
    commit(spark.createDataFrame([(1,)], "Id long"), path)
    bad = spark.range(0, 10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("boom")))
                                    .otherwise(F.col("id")).alias("Id"))
    with pytest.raises(Exception, match="boom"):
        commit(bad, path)
    assert sorted(os.listdir(base)) == ["t"]
    assert spark.read.parquet(path).count() == 1


def test_chunks_on_text_ids(spark):
    df = spark.createDataFrame([(f"001A{i:05d}", i) for i in range(250)], "Id string, n long")
    chunks = key_chunks(df, "Id", 100).orderBy("chunk_id").collect()
    assert [(c.chunk_id, c.rows) for c in chunks] == [(0, 100), (1, 100), (2, 50)]
    assert chunks[0].lo == "001A00000" and chunks[1].lo == "001A00100"
    assert read_chunked(df, "Id", 100).count() == 250


def test_non_queryable_objects(spark):
    cat = Catalog(spark)
    cat.register("Visible", spark.createDataFrame([(1,)], "Id long"))
    cat.register("Hidden", spark.createDataFrame([(2,)], "Id long"), queryable=False)
    assert {r.name for r in cat.summary(queryable_only=True).collect()} == {"Visible"}
    assert {r.name for r in cat.summary().collect()} == {"Visible", "Hidden"}
    assert select_objects(cat) == ["Visible"]
    with pytest.raises(CatalogError, match="not queryable"):
        select_objects(cat, "Hidden")
