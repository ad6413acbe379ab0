"""Cases that earlier versions got wrong, each with its defined result."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objectlake import Catalog, CatalogError, ObjectQuery, fld
from objectlake.functions.timefilter import DurationError, range_bounds
from objectlake.operators.category import category_nodes
from objectlake.operators.chunking import chunk_eligibility, key_chunks
from objectlake.operators.codec import decode, time_field
from objectlake.operators.packing import pack_batches
from objectlake.sinks.csvbatch import write_csv_batches
from objectlake.sinks.write import swap, validate_write
from objectlake.streaming.changes import changed_fields, decode_changes, notify, notify_for_fields

T0 = dt.datetime(2024, 1, 1)


# -- F-10, V-06: no filter is lost ----------------------------------------------
@pytest.mark.parametrize("options", [{"duration": "6 hours"}, {"offset": "1 days"}])
def test_duration_needs_a_time(cat, options):
    with pytest.raises(DurationError, match="as_of"):
        cat.object("Opportunity", **options)


@pytest.mark.parametrize("options", [{"since": "not a time"}, {"as_of": T0, "duration": "6 fortnights"}])
def test_scan_options_are_checked(cat, options):
    with pytest.raises(ValueError):
        cat.object("Opportunity", **options)


@pytest.mark.parametrize("duration,start", [
    ("5000000000 nanos", T0 - dt.timedelta(seconds=5)), ("1500 nanos", T0 - dt.timedelta(microseconds=1)),
    ("1 seconds, 1 nanos", T0 - dt.timedelta(seconds=1)), ("999 nanos", T0)])
def test_nanoseconds_count(duration, start):
    assert range_bounds(T0, duration, None) == (start, T0)
    assert range_bounds(T0, "0 nanos", "0 days") == (None, None)


# -- T-07, D-04, T-02, T-03: messages ---------------------------------------------
SCHEMA = T.StructType([T.StructField("Id", T.LongType(), False), T.StructField("Value", T.DoubleType()), T.StructField("Day", T.DateType())])
MESSAGES = [
    '{"event":{"type":"created"},"sobject":{"Id":1,"Value":"2.5"}}',
    '{"event":{"type":"updated"},"sobject":{"Id":2,"Value":"abc","Day":"x"}}',
    '{"event":{"type":"updated"},"sobject":{"Id":3,"ID":4,"Value":1}}',
    '{"sobject":{"Id":5}}', '{"event":{"type":"merged"},"sobject":{"Id":6}}', '{"sobject":{"Value":1}}', "no json", '{"sobject":7}']


def messages(spark):
    return spark.createDataFrame([(m,) for m in MESSAGES], "value string")


def test_quarantine_accounts_for_all(spark):
    good, bad = decode_changes(messages(spark), SCHEMA, on_error="quarantine")
    assert sorted(r["Id"] for r in good.collect()) == [1, 4, 5, 6]
    assert {r["message"]: r["fields"] for r in bad.collect()} == {
        MESSAGES[1]: ["Value", "Day"], MESSAGES[5]: ["Id"], MESSAGES[6]: [], MESSAGES[7]: []}


def test_quarantine_in_a_stream(spark, tmp_path):
    from objectlake.streaming.changes import start_change_stream
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.txt").write_text("\n".join(MESSAGES))
    q = start_change_stream(spark, str(tmp_path / "in"), SCHEMA, str(tmp_path / "out"), str(tmp_path / "ck"),
                            quarantine_path=str(tmp_path / "bad"), available_now=True)
    assert q.awaitTermination(120) and q.exception() is None
    assert spark.read.parquet(str(tmp_path / "out")).count() + spark.read.parquet(str(tmp_path / "bad")).count() == len(MESSAGES)


def test_events_without_an_operation_stay(spark):
    good, _ = decode_changes(messages(spark), SCHEMA, on_error="quarantine")
    assert notify(good).count() == 4
    assert sorted(r["Id"] for r in notify(good, create=False, update=False).collect()) == [5, 6]
    assert sorted(r["Id"] for r in notify_for_fields(good, "Select", ["Nothing"]).collect()) == [1, 4, 5, 6]


def test_changed_fields_after_union(spark, tmp_path):
    rows = spark.createDataFrame([('{"event":{"type":"updated"},"before":{"Value":"1"},"sobject":{"Id":1,"Value":"2"}}',)], "value string")
    decoded = decode_changes(rows, SCHEMA)
    both = decoded.unionByName(decoded)
    both.write.parquet(str(tmp_path / "rows"))
    for df in (both, spark.read.parquet(str(tmp_path / "rows"))):
        assert [r[0] for r in df.select(changed_fields(df, ["Value", "Day"])).collect()] == [["value"], ["value"]]


# -- W-12, W-01: the table survives -----------------------------------------------
class Files:
    """Folders by name; ``refuse`` lists renames that fail."""

    def __init__(self, names, refuse=()):
        self.names, self.refuse = set(names), set(refuse)

    def exists(self, p):
        return p in self.names

    def rename(self, a, b):
        if (a in self.refuse) or a not in self.names:
            return False
        self.names.remove(a)
        self.names.add(f"{b}/{a.rpartition('/')[2]}" if b in self.names else b)
        return True

    def delete(self, p, _):
        self.names.discard(p)


def test_swap():
    fs = Files({"/t", "/t.new"})
    swap(fs, str, "/t.new", "/t")
    assert fs.names == {"/t"}


def test_failed_swap_keeps_the_old_table():
    fs = Files({"/t", "/t.new"}, refuse={"/t.new"})
    with pytest.raises(CatalogError, match="old one is back"):
        swap(fs, str, "/t.new", "/t")
    assert fs.names == {"/t", "/t.new"}
    fs = Files({"/t", "/t.new"}, refuse={"/t"})
    with pytest.raises(CatalogError, match="unchanged"):
        swap(fs, str, "/t.new", "/t")
    assert fs.names == {"/t", "/t.new"}


def test_swap_beside_another_writer():
    class Raced(Files):
        def rename(self, a, b):
            done = super().rename(a, b)
            if a == "/t" and "__previous" in b:
                self.names.add("/t")        # another commit arrives
            return done
    fs = Raced({"/t", "/t.new"})
    with pytest.raises(CatalogError, match="old one is at"):
        swap(fs, str, "/t.new", "/t")
    assert {"/t", "/t.new"} < fs.names and len(fs.names) == 3


def test_insert_only_adds_files(spark, tmp_path):
    path = str(tmp_path / "Thing")
    spark.range(5).select(F.col("id").alias("Id"), F.lit("a").alias("Name")).write.parquet(path)
    cat = Catalog(spark)
    cat.register("Thing", path)
    for i in (1, 2):
        before = {n: os.path.getmtime(os.path.join(path, n)) for n in os.listdir(path) if n.startswith("part-")}
        cat.append("Thing", spark.range(10 * i, 10 * i + 3).select(F.col("id").alias("ID")))
        assert all(os.path.getmtime(os.path.join(path, n)) == t for n, t in before.items())
    assert cat.table("Thing").count() == 11 and cat.table("Thing").where("Name is null").count() == 6


def test_only_the_own_key_is_exempt():
    target = T.StructType([T.StructField("Id", T.LongType()), T.StructField("Ext", T.StringType()), T.StructField("Name", T.StringType())])
    assert validate_write(target, target, "insert", read_only=["Id"])
    assert validate_write(target, target, "upsert", "Ext", external_ids=["Ext"], read_only=["Id"])
    assert not validate_write(target, target, "upsert", "Id", read_only=["Id"])
    assert not validate_write(target, target, "update", read_only=["Id"])


# -- J-05 under OR ----------------------------------------------------------------
def test_not_in_under_or(spark):
    cat = Catalog(spark)
    cat.register("A", spark.createDataFrame([(1, "x"), (2, "y"), (3, None), (99, "y")], "Id long, K string"))
    cat.register("B", spark.createDataFrame([("y",), (None,)], "K string"))
    cat.register("E", spark.createDataFrame([], "K string"))

    def ids(cond):
        df = ObjectQuery(cat, "A").select("Id").where(cond).to_df()
        assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
        return sorted(r[0] for r in df.collect())
    sub = ObjectQuery(cat, "B").select("K")
    assert ids(fld("K").notin(sub, null_safe=True) | (fld("Id") == 99)) == [1, 3, 99]
    assert ids(fld("K").notin(sub) | (fld("Id") == 99)) == [99]
    assert ids(fld("K").isin(sub) | (fld("Id") == 1)) == [1, 2, 99]
    assert ids(~fld("K").isin(sub)) == []
    empty = ObjectQuery(cat, "E").select("K")
    assert ids(fld("K").notin(empty) | (fld("Id") == 99)) == [1, 2, 3, 99]


# -- F-18, A-16: any depth, nothing runs for a schema ------------------------------
def test_deep_and_cyclic_categories(spark):
    deep = spark.range(1, 110).select(F.col("id").cast("string").alias("child"), (F.col("id") - 1).cast("string").alias("parent"))
    assert category_nodes(spark, deep, "BELOW", ["3"]).count() == 107
    ring = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string")
    assert category_nodes(spark, ring, "ABOVE_OR_BELOW", ["a"]).count() == 3


def test_schema_runs_nothing(spark, cat):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("schema-only", "schema")
    try:
        ObjectQuery(cat, "Opportunity").select("Id", "Amount").order_by("Id").offset(5).schema()
        assert list(tracker.getJobIdsForGroup("schema-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# -- D-01, S-08, S-09, W-06 ---------------------------------------------------------
def test_strict_times(spark):
    st = T.StructType([time_field("t")])
    rows = spark.createDataFrame([("99:99:99",), ("10:20xyz",), ("10:20",), ("23:59:59.5",), ("10:20:30Z",), ("24:00",)], "t string")
    assert [r["t"] for r in decode(rows, st, strict=False).collect()] == [None, None, 37_200_000_000, 86_399_500_000, 37_230_000_000, None]


def test_large_keys_keep_their_chunk(spark):
    rows = spark.createDataFrame([(0,), (2 ** 53 + 1,), (2 ** 62,)], "k long")
    assert sorted(r["chunk_id"] for r in key_chunks(rows, "k", 1).collect()) == [0, 2 ** 53 + 1, 2 ** 62]


def test_keys_more_than_a_long_apart(spark):
    rows = spark.createDataFrame([(-2 ** 63,), (-5,), (2 ** 63 - 1,), (None,)], "k long")
    size = 10 ** 5
    got = {r["lo"]: r["chunk_id"] for r in key_chunks(rows, "k", size).collect()}
    assert got == {k: (k + 2 ** 63) // size for k in (-2 ** 63, -5, 2 ** 63 - 1)} | {None: None}


def test_chunking_rules(cat):
    q = ObjectQuery(cat, "Opportunity").select("Id")
    assert chunk_eligibility(q) == []
    assert chunk_eligibility(q.with_filter(fld("Amount") > 1))
    assert chunk_eligibility(q, parent="Nothing")


def test_written_batches_keep_the_byte_cap(spark, tmp_path):
    rows = spark.range(400).select("id", *[F.timestamp_seconds(F.col("id") * 1000 + i).alias(f"t{i}") for i in range(3)])
    write_csv_batches(pack_batches(rows, max_records=500, max_bytes=2000, order_by=["id"]), str(tmp_path / "out"))
    sizes = [os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(tmp_path / "out") for n in names if n.endswith(".csv")]
    assert len(sizes) > 10 and max(sizes) <= 2000
