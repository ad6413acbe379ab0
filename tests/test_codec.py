import base64
import datetime as dt
import decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake.operators.codec import (TIME_MILLIS, conformance, decode, encode, flatten, split_attachments,
                                        time_field)


def _strings(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))


def test_decode_types_and_names(spark):
    nested = T.ArrayType(T.StructType([T.StructField("nested_string", T.StringType()),
                                       T.StructField("nested_long", T.LongType()),
                                       T.StructField("nested_timestamp", T.TimestampType())]))
    schema = T.StructType([
        T.StructField("string_field", T.StringType()), T.StructField("int_field", T.IntegerType()),
        T.StructField("long_field", T.LongType()), T.StructField("float_field", T.FloatType()),
        T.StructField("double_field", T.DoubleType()), T.StructField("boolean_field", T.BooleanType()),
        T.StructField("date_field", T.DateType()), T.StructField("timestamp_field", T.TimestampType()),
        time_field("time_field"), T.StructField("A_B", T.StringType()), T.StructField("children", nested)])
    df = spark.createDataFrame(
        [("text", "12", "1234567890123", "1.5", "2.25", "TRUE", "2019-03-05", "2019-03-05T10:12:23.123456Z",
          "05:00:00.500Z", "dotted", "ignored",
          [{"Nested.String": "n", "NESTED_LONG": "7", "nested_timestamp": "2020-01-01T00:00:00Z"}])],
        "STRING_FIELD string, int_field string, long_field string, float_field string, double_field string, "
        "boolean_field string, date_field string, timestamp_field string, time_field string, `A.B` string, "
        "unknown string, children array<map<string,string>>")
    r = decode(df, schema).first()
    assert r.string_field == "text" and r.int_field == 12 and r.long_field == 1234567890123
    assert r.float_field == 1.5 and r.double_field == 2.25 and r.boolean_field is True
    assert r.date_field == dt.date(2019, 3, 5)
    assert r.timestamp_field == dt.datetime(2019, 3, 5, 10, 12, 23, 123000)   # millis kept only
    assert r.time_field == 5 * 3600 * 10**6 + 500000
    assert r.A_B == "dotted"
    assert r.children == [Row(nested_string="n", nested_long=7, nested_timestamp=dt.datetime(2020, 1, 1))]


def test_decode_null_rules(spark):
    schema = T.StructType([T.StructField("s", T.StringType()), T.StructField("d", T.DoubleType()),
                           T.StructField("req", T.DoubleType(), False), T.StructField("b", T.BooleanType())])
    ok = decode(_strings(spark, [("", "", "", "yes")], ["s", "d", "req", "b"]), schema).first()
    assert ok.s is None and ok.d is None and ok.req is None and ok.b is False   # Q1, Q3
    with pytest.raises(Exception, match="is required"):
        decode(_strings(spark, [("a", "1", None, "x")], ["s", "d", "req", "b"]), schema).collect()   # Q2
    with pytest.raises(Exception):
        decode(_strings(spark, [("a", "1.x", "1", "x")], ["s", "d", "req", "b"]), schema).collect()
    lenient = decode(_strings(spark, [("a", "1.x", None, "x")], ["s", "d", "req", "b"]), schema, strict=False).first()
    assert lenient.d is None and lenient.req is None


def test_decode_date_as_instant(spark):
    schema = T.StructType([T.StructField("d", T.DateType())])
    rows = decode(_strings(spark, [("2020-02-03",), ("2020-02-03T23:10:00Z",)], ["d"]), schema).collect()
    assert [r.d for r in rows] == [dt.date(2020, 2, 3), dt.date(2020, 2, 3)]


def test_encode_all_types(spark):
    schema = T.StructType([
        T.StructField("date_field", T.DateType()), T.StructField("ts_micros", T.TimestampType()),
        time_field("time_micros"), T.StructField("ts_millis", T.TimestampType()),
        time_field("time_millis", TIME_MILLIS), T.StructField("string_field", T.StringType()),
        T.StructField("datetime_field", T.TimestampNTZType()), T.StructField("decimal_field", T.DecimalType(15, 3)),
        T.StructField("bool_field", T.BooleanType()), T.StructField("null_field", T.StringType())])
    rows = [(dt.date(2023, 6, 12), dt.datetime(2023, 6, 12, 7, 0, 0), 7 * 3600 * 10**6 + 123456,
             dt.datetime(2023, 6, 12, 7, 0, 0, 45000), 7 * 3600 * 1000, "text", dt.datetime(2023, 6, 12, 7, 30, 5),
             decimal.Decimal("12.500"), True, None),
            (dt.date(1, 1, 1), dt.datetime(1, 1, 1, 0, 0), 0, dt.datetime(1, 1, 1, 0, 0, 1), 61001, "x",
             dt.datetime(1, 1, 1, 0, 0), decimal.Decimal("-0.001"), False, None)]
    out = encode(spark.createDataFrame(rows, schema)).collect()
    assert tuple(out[0]) == ("2023-06-12", "2023-06-12T07:00:00Z", "07:00:00.123Z", "2023-06-12T07:00:00.045Z",
                             "07:00", "text", "2023-06-12T07:30:05", "12.500", "true", None)
    assert tuple(out[1]) == ("0001-01-01", "0001-01-01T00:00:00Z", "00:00:00.000Z", "0001-01-01T00:00:01Z",
                             "00:01:01.001", "x", "0001-01-01T00:00", "-0.001", "false", None)


def test_encode_rejects_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"x"),)], "b binary")
    with pytest.raises(Exception, match="unsupported"):
        encode(df)


def test_flatten_parent_and_children(spark):
    df = spark.createDataFrame(
        [(1, "Opp", 10.0, (5, "Campaign A"), [(1, ("x",)), (2, None)]), (2, "Opp2", 3.0, None, None)],
        "Id long, Name string, Amount double, Campaign struct<Id:long, Name:string>, "
        "Contacts array<struct<Id:long, Owner:struct<Status:string>>>")
    out = flatten(df, ["Id", ("Name", "n"), "Campaign.Name"], children={"Contacts": ["Id", "Owner.Status"]})
    rows = out.orderBy("Id").collect()
    assert out.columns == ["Id", "n", "Campaign_Name", "Contacts"]
    assert rows[0].Campaign_Name == "Campaign A" and rows[0].Contacts[0].Owner_Status == "x"
    assert rows[0].Contacts[1].Owner_Status is None
    assert rows[1].Campaign_Name is None and rows[1].Contacts == []


def test_split_attachments(spark):
    body = base64.b64encode(b"%PDF-bytes").decode()
    df = spark.createDataFrame([(2, "attachment.pdf", body), (1, "a.txt", base64.b64encode(b"hi").decode())],
                               "Id int, Name string, Body string")
    rows, files = split_attachments(df, "Attachment", order_by="Id")
    got = {r.Id: r.Body for r in rows.collect()}
    assert got == {1: "#1_a.txt", 2: "#2_attachment.pdf"}
    f = {r.key: (bytes(r.content), r.size) for r in files.collect()}
    assert f["2_attachment.pdf"] == (b"%PDF-bytes", 10)
    with pytest.raises(Exception, match="larger than the byte limit"):
        split_attachments(df, "Attachment", order_by="Id", max_bytes=5)[1].collect()
    with pytest.raises(Exception):
        split_attachments(df, "Document")


def test_conformance_verdicts(spark):
    df = _strings(spark, [("1", "", "a"), ("x", "2", None), ("3", "4", "c")], ["n", "req", "s"])
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("req", T.LongType(), False),
                           T.StructField("s", T.StringType()), T.StructField("gone", T.StringType())])
    rep = {r.field: r for r in conformance(df, schema).collect()}
    assert rep["n"].bad_values == 1 and rep["n"].verdict == "type mismatch"
    assert rep["req"].blanks == 1 and rep["req"].verdict == "null in required field"
    assert rep["s"].nulls == 1 and rep["s"].verdict == "ok"
    assert rep["gone"].verdict == "missing" and rep["gone"].rows == 3


def test_encode_datetime_text(spark):
    from objectlake.operators.codec import DATETIME_TEXT, TIME_KEY
    f = T.StructField("dt", T.StringType(), True, {TIME_KEY: DATETIME_TEXT})
    good = spark.createDataFrame([("2023-06-12T07:00",), ("2023-06-12T07:00:01.5",), (None,)], T.StructType([f]))
    assert [r.dt for r in encode(good).collect()] == ["2023-06-12T07:00", "2023-06-12T07:00:01.5", None]
    bad = spark.createDataFrame([("12/06/2023",)], T.StructType([f]))
    with pytest.raises(Exception, match="ISO-8601"):
        encode(bad).collect()


def test_describe(cat):
    d = cat.describe("Opportunity")
    assert d["id_field"] == "Id" and {"name": "Account", "field": "AccountId", "target": "Account"} in d["references"]
    assert any(c["name"] == "LineItems" for c in d["children"])
    amount = [f for f in d["fields"] if f["name"] == "Amount"][0]
    assert amount["type"] == "double" and amount["field_type"] == "currency"


def test_encode_epoch_instant_values(spark):
    """Time fields hold whole instants; only the time of day is written."""
    schema = T.StructType([T.StructField("d", T.DateType()), time_field("tm"), time_field("tms", TIME_MILLIS),
                           T.StructField("ts", T.TimestampType()), T.StructField("dec", T.DecimalType(15, 3))])
    df = spark.createDataFrame([(19520, 1686553200000000, 1686553200000, 1686553200000000, "1234234.221"),
                                (-719162, -62135593200000000, -62135593200000, -62135593200000000, "1.321")],
                               "d int, tm long, tms long, ts long, dec string")
    typed = df.select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("d")).alias("d"),
                      F.col("tm").alias("tm", metadata=schema["tm"].metadata),
                      F.col("tms").alias("tms", metadata=schema["tms"].metadata),
                      F.timestamp_micros("ts").alias("ts"), F.col("dec").cast("decimal(15,3)").alias("dec"))
    rows = [tuple(r) for r in encode(typed).collect()]
    assert rows == [("2023-06-12", "07:00:00.000Z", "07:00", "2023-06-12T07:00:00Z", "1234234.221"),
                    ("0001-01-01", "01:00:00.000Z", "01:00", "0001-01-01T01:00:00Z", "1.321")]


def test_strict_number_and_instant_text(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("ts", T.TimestampType())])
    ok = decode(_strings(spark, [("+12", "2019-05-20T01:01:01+02:00")], ["n", "ts"]), schema).first()
    assert ok.n == 12 and ok.ts == dt.datetime(2019, 5, 19, 23, 1, 1)
    for bad in [(" 12", "2019-05-20T01:01:01Z"), ("1.0", "2019-05-20T01:01:01Z"), ("12", "2019-05-20T01:01:01"),
                ("12", "2019-05-20")]:
        with pytest.raises(Exception, match="cannot be read"):
            decode(_strings(spark, [bad], ["n", "ts"]), schema).collect()
    loose = decode(_strings(spark, [(" 12", "2019-05-20T01:01:01")], ["n", "ts"]), schema, strict=False).first()
    assert loose.n == 12 and loose.ts == dt.datetime(2019, 5, 20, 1, 1, 1)


def test_decode_typed_input(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("d", T.DoubleType())])
    ok = decode(spark.createDataFrame([(5, 1)], "n long, d long"), schema).first()
    assert ok.n == 5 and ok.d == 1.0
    with pytest.raises(Exception, match="cannot be read"):
        decode(spark.createDataFrame([(2 ** 40, 1)], "n long, d long"), schema).collect()
    with pytest.raises(Exception, match="is required"):
        decode(spark.createDataFrame([(None, 1)], "n long, d long"), schema).collect()


def test_decode_complexvalue_and_record(spark):
    schema = T.StructType([
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("owner", T.StructType([T.StructField("Name", T.StringType()),
                                             T.StructField("Age", T.IntegerType())]))])
    df = spark.createDataFrame([('["a","b"]', {"NAME": "Ann", "age": "41", "x": "y"}), ("", None)],
                               "tags string, owner map<string,string>")
    rows = decode(df, schema).collect()
    assert rows[0].tags == ["a", "b"] and rows[0].owner.Name == "Ann" and rows[0].owner.Age == 41
    assert rows[1].tags is None and rows[1].owner is None
