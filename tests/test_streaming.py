import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake.streaming.changes import decode_changes, notify, notify_for_fields, read_changes

def _finish(query):
    """Wait for an availableNow run; stop it and fail if it does not end."""
    done = query.awaitTermination(300)
    if not done:
        query.stop()
    assert done, "stream did not finish"


SCHEMA = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Type", T.StringType()),
                       T.StructField("Value", T.DoubleType()), T.StructField("LastModifiedDate", T.TimestampType()),
                       T.StructField("Props", T.StringType())])


def _messages(spark):
    import __spark_entry__ as e
    return e._change_messages(spark, "/root/testdata/sf0.001")


def test_stream_equals_batch(spark):
    """S-15/T-01/T-02/T-03: the same transforms over a file stream run with
    availableNow give the rows of the batch run."""
    src = tempfile.mkdtemp(prefix="objectlake-msgs-")
    _messages(spark).write.mode("overwrite").text(os.path.join(src, "in"))
    out = tempfile.mkdtemp(prefix="objectlake-out-")

    def pipeline(df):
        return notify_for_fields(notify(df, delete=False), "Referenced", ["Type"], ["Value"],
                                 cond=F.col("Value") > 10).select("Id", "Type", "Value", "_replay_id")

    stream = pipeline(read_changes(spark, os.path.join(src, "in"), SCHEMA))
    q = (stream.writeStream.format("parquet").option("path", os.path.join(out, "data"))
         .option("checkpointLocation", os.path.join(out, "ckpt")).trigger(availableNow=True).start())
    _finish(q)
    got = spark.read.parquet(os.path.join(out, "data"))
    batch = pipeline(decode_changes(spark.read.text(os.path.join(src, "in")), SCHEMA))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0


def test_nested_object_kept_as_text_and_case(spark):
    msgs = spark.createDataFrame([
        ('{"event":{"type":"updated"},"sobject":{"ID":5,"tYpe":"x","props":{"k":1},"Extra":1}}',),
        ('{"event":{"type":"created"},"sobject":{"Id":6,"Value":"2.5"}}',)], "value string")
    rows = {r.Id: r for r in decode_changes(msgs, SCHEMA).collect()}
    assert rows[5].Type == "x" and rows[5].Props == '{"k":1}' and rows[5].Value is None
    assert rows[6].Value == 2.5 and rows[6]._op == "created"


def test_bad_message_policy(spark):
    msgs = spark.createDataFrame([('{"sobject":{"Id":1}}',), ("not json",), ('{"event":{}}',)], "value string")
    with pytest.raises(Exception, match="Invalid change message"):
        decode_changes(msgs, SCHEMA).collect()
    good, bad = decode_changes(msgs, SCHEMA, on_error="quarantine")
    assert good.count() == 1 and bad.count() == 2
    with pytest.raises(Exception):
        decode_changes(spark.createDataFrame([('{"sobject":{"Id":1,"Value":{"a":1}}}',)], "value string"),
                       SCHEMA).collect()


def test_field_change_from_before_image(spark):
    msgs = spark.createDataFrame([
        ('{"event":{"type":"updated","replayId":1},"sobject":{"Id":1,"Type":"a","Value":5},'
         '"before":{"Id":1,"Type":"a","Value":4}}',),
        ('{"event":{"type":"updated","replayId":2},"sobject":{"Id":1,"Type":"b","Value":5},'
         '"before":{"Id":1,"Type":"a","Value":5}}',),
        ('{"event":{"type":"deleted","replayId":3},"sobject":{"Id":1,"Type":"b","Value":5}}',)], "value string")
    rows = decode_changes(msgs, SCHEMA)
    ids = lambda df: sorted(r._replay_id for r in df.collect())
    assert ids(notify_for_fields(rows, "Select", select_fields=["Type"])) == [2, 3]
    assert ids(notify_for_fields(rows, "Where", where_fields=["value"])) == [1, 3]
    assert ids(notify_for_fields(rows, "All", cond=F.col("Type") == "b")) == [2, 3]
    assert ids(notify(rows, update=False)) == [3]
    with pytest.raises(Exception):
        notify_for_fields(rows, "Sometimes")


def test_object_query_over_stream(spark):
    """T-04: an ObjectQuery's fields and filters applied to a stream."""
    from objectlake import Catalog, ObjectQuery, fld
    src = tempfile.mkdtemp(prefix="objectlake-msgs-")
    _messages(spark).write.mode("overwrite").text(os.path.join(src, "in"))
    stream = read_changes(spark, os.path.join(src, "in"), SCHEMA)
    cat = Catalog(spark)
    cat.register("UserState", decode_changes(spark.read.text(os.path.join(src, "in")), SCHEMA))
    q = ObjectQuery(cat, "UserState").select("Id", "Value").where((fld("Type") == "purchase") & (fld("Value") > 30))
    out = tempfile.mkdtemp(prefix="objectlake-out-")
    run = (q.over(stream).writeStream.format("parquet").option("path", os.path.join(out, "d"))
           .option("checkpointLocation", os.path.join(out, "c")).trigger(availableNow=True).start())
    _finish(run)
    got = spark.read.parquet(os.path.join(out, "d"))
    want = q.to_df()
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_start_change_stream_with_quarantine(spark):
    from objectlake.streaming.changes import start_change_stream
    src = tempfile.mkdtemp(prefix="objectlake-msgs-")
    msgs = _messages(spark)
    bad = spark.createDataFrame([("garbage",), ('{"event":{"type":"updated"}}',)], "value string")
    msgs.unionByName(bad).write.mode("overwrite").text(os.path.join(src, "in"))
    out = tempfile.mkdtemp(prefix="objectlake-out-")
    q = start_change_stream(spark, os.path.join(src, "in"), SCHEMA, os.path.join(out, "rows"),
                            os.path.join(out, "ckpt"), operations={"delete": False},
                            quarantine_path=os.path.join(out, "bad"), available_now=True)
    _finish(q)
    rows = spark.read.parquet(os.path.join(out, "rows"))
    want = notify(decode_changes(msgs, SCHEMA), delete=False)
    assert rows.count() == want.count() > 0
    assert spark.read.parquet(os.path.join(out, "bad")).count() == 2
    # without a quarantine a bad message stops the stream
    out2 = tempfile.mkdtemp(prefix="objectlake-out-")
    q2 = start_change_stream(spark, os.path.join(src, "in"), SCHEMA, os.path.join(out2, "rows"),
                             os.path.join(out2, "ckpt"), available_now=True)
    with pytest.raises(Exception):
        q2.awaitTermination(120)
        if q2.exception() is not None:
            raise q2.exception()


def test_stream_with_parent_reference(spark):
    """T-04 with a parent path: the stream is enriched by a stream-static
    left join to the Account table."""
    from objectlake import ObjectQuery, fld
    from objectlake.sampledata import sample_catalog
    src = tempfile.mkdtemp(prefix="objectlake-msgs-")
    _messages(spark).write.mode("overwrite").text(os.path.join(src, "in"))
    cat = sample_catalog(spark, "/root/testdata/sf0.001")
    cat.register("UserState", decode_changes(spark.read.text(os.path.join(src, "in")), SCHEMA, keep_event=False))
    cat.add_reference("UserState", "Account", "Id", "Account")
    q = (ObjectQuery(cat, "UserState").select("Id", "Type", "Account.Segment")
         .where((fld("Type") == "purchase") & (fld("Account.Segment") != "BUILDING")))
    stream = read_changes(spark, os.path.join(src, "in"), SCHEMA).drop("_op", "_replay_id", "_changed", "_before")
    out = tempfile.mkdtemp(prefix="objectlake-out-")
    run = (q.over(stream).writeStream.format("parquet").option("path", os.path.join(out, "d"))
           .option("checkpointLocation", os.path.join(out, "c")).trigger(availableNow=True).start())
    _finish(run)
    got = spark.read.parquet(os.path.join(out, "d"))
    want = q.to_df()
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


def test_prior_images_are_kept_by_key(spark):
    """T-03: updates without ``before`` and ``changedFields`` fire for the fields
    that differ from the record's last image, over restarts too."""
    import json

    from objectlake.streaming.changes import start_change_stream, with_last_image
    src, out = tempfile.mkdtemp(prefix="objectlake-msgs-"), tempfile.mkdtemp(prefix="objectlake-out-")

    def message(replay, op, **fields):
        return json.dumps({"event": {"type": op, "replayId": replay}, "sobject": fields})

    def put(name, *messages):
        with open(os.path.join(src, name + ".tmp"), "w") as f:
            f.write("\n".join(messages) + "\n")
        os.rename(os.path.join(src, name + ".tmp"), os.path.join(src, name))

    def run():
        _finish(start_change_stream(spark, src, SCHEMA, os.path.join(out, "rows"), os.path.join(out, "ckpt"), field_mode="Select",
                                    select_fields=["Type"], quarantine_path=os.path.join(out, "bad"), available_now=True, remember="Id",
                                    pathGlobFilter="*.txt"))
        return sorted(((r.Id, r._replay_id) for r in spark.read.parquet(os.path.join(out, "rows")).collect()), key=str)
    put("1.txt", message(2, "updated", Id=1, Type="a", Value=6), message(1, "created", Id=1, Type="a", Value=5),      # out of order
        message(3, "updated", ID=2, Type="x"), message(4, "updated", Id=2, Value=9), "no JSON", message(5, "updated", Type="z"))
    assert run() == sorted([(1, 1), (2, 3), (None, 5)], key=str)
    put("2.txt", message(6, "updated", Id=1, Type="a", Value=7), message(7, "updated", Id=1, Type="b"), message(8, "deleted", Id=2, Type="x"),
        message(9, "updated", Id=2, Type="x"), message(10, "updated", Id=2, Type=None))
    assert run() == sorted([(1, 1), (2, 3), (None, 5), (1, 7), (2, 8), (2, 9), (2, 10)], key=str)
    assert spark.read.parquet(os.path.join(out, "bad")).count() == 1
    with pytest.raises(Exception, match="streams only"):
        with_last_image(_messages(spark), "Id")
