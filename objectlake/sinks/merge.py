"""Update and upsert that rewrite only the files with an input key (W-02, W-03).

Beside a table's data files lies a key summary: per file its least and greatest key
and a Bloom filter, cut into 64-bit words.  A key's hash names a word and
four of its bits, so testing keys against all files is one equi-join on the word
number.  The files that may hold a key are then scanned for it, key column only, and
those that do are rewritten; all others stay as they are, names included.  New
files and the untouched ones together are the next version (:mod:`.versions`).

The summary is a table too: it is built by aggregates, files that it lacks (those
of the last commit, or of another writer) are added when a merge next needs it, and
rows of replaced files drop out by a join with the version's list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import CatalogError
from ..naming import quote
from ..session import scratch_path
from . import versions
from .write import _align, _blank, _by_key, _cast_to, apply_write, error_policy

#: keys a 64-bit word of a filter takes on average: four of its bits a key leave about
#: one absent key in a hundred undetected
KEYS_A_WORD = 4


@dataclass
class MergeResult:
    version: int
    rewritten: list[str]        # files that held an input key, replaced
    added: list[str]            # their successors, new rows included
    untouched: int              # files that stay
    rejected: DataFrame         # input rows refused, with an ``error`` column


def _mask(key: Column) -> Column:
    """Four bits of a word for a key, from a hash other than its word's."""
    h = F.xxhash64(F.lit("bits"), key)
    one = F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def _word(key: Column, words: Column) -> Column:
    """A key's word in a filter of ``words`` words (a power of two)."""
    return F.xxhash64(F.lit("word"), key).bitwiseAND(words - 1)


def _file_name(path: str) -> Column:
    """The name, below ``path``, of the file a row is read from."""
    depth = path.rstrip("/").rpartition("/")[2]
    full = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return F.substring_index(full, f"/{depth}/", -1)


def _keys_with_file(spark: SparkSession, snap: versions.Snapshot, names: list[str], key: str, schema) -> DataFrame:
    rows = versions.read_files(spark, snap, names, schema)
    return rows.select(F.col(quote(key)).alias("key"), _file_name(snap.path).alias("file")).where("key is not null")


def summarise(spark: SparkSession, snap: versions.Snapshot, names: list[str], key: str, schema) -> None:
    """Add the summaries of some files to the table's key summary."""
    keys = _keys_with_file(spark, snap, names, key, schema)
    files = spark.createDataFrame([(n,) for n in names], "file string")
    told = keys.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    wanted = F.ceil(F.col("n") / KEYS_A_WORD)
    told = files.join(told, "file", "left").select(
        "file", F.coalesce("n", F.lit(0)).alias("n"), "low", "high",
        F.coalesce(F.call_function("shiftleft", F.lit(1).cast("long"), F.ceil(F.log2(F.greatest(wanted, F.lit(1)))).cast("int")), F.lit(1).cast("long")).alias("words"))
    at = _summary_path(snap.path, key)
    made = scratch_path(spark, "key-summary")
    told.write.parquet(made)
    told = spark.read.parquet(made)
    bits = (keys.join(told.select("file", "words"), "file")
            .groupBy("file", "words", _word(F.col("key"), F.col("words")).alias("word")).agg(F.bit_or(_mask(F.col("key"))).alias("bits")))
    bits.write.mode("append").parquet(f"{at}/bits")
    told.write.mode("append").parquet(f"{at}/files")     # last: a file counts as summarised once its bits are there


def _summary_path(path: str, key: str) -> str:
    return f"{path}/_keys/{key}"


def _summary(spark: SparkSession, snap: versions.Snapshot, key: str, schema) -> tuple[DataFrame, DataFrame]:
    """The summary of the version's files, made first where it is missing."""
    at = _summary_path(snap.path, key)
    fs, make = versions._fs(spark, snap.path)
    current = spark.createDataFrame([(n,) for n in snap.files], "file string")
    known = spark.read.parquet(f"{at}/files").select("file") if fs.exists(make(f"{at}/files")) else current.limit(0)
    missing = [r["file"] for r in current.join(known, "file", "left_anti").collect()]
    if missing:
        summarise(spark, snap, missing, key, schema)
    files = spark.read.parquet(f"{at}/files").join(current, "file", "left_semi").dropDuplicates(["file"])
    return files, spark.read.parquet(f"{at}/bits").join(current, "file", "left_semi")


def files_that_may_hold(spark: SparkSession, files: DataFrame, bits: DataFrame, keys: DataFrame) -> DataFrame:
    """The files whose summary doesn't rule out every key of ``keys`` (column ``key``)."""
    sizes = [r["words"] for r in files.select("words").distinct().collect()]      # powers of two: at most 63
    probes = (keys.select("key", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])).alias("words"))
              .select("key", "words", _word(F.col("key"), F.col("words")).alias("word"), _mask(F.col("key")).alias("mask")))
    hits = bits.join(probes, ["words", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    return hits.join(files.select("file", "low", "high"), "file").where(F.col("key").between(F.col("low"), F.col("high"))).select("file").distinct()


def touched_files(spark: SparkSession, snap: versions.Snapshot, keys: DataFrame, key: str, schema) -> list[str]:
    """The files that hold a key of ``keys`` (column ``key``, distinct).

    Their summaries name candidates unless there are so many keys and files
    that testing them all costs more than the key column's scan; the scan of the
    candidates decides."""
    if not snap.files:
        return []
    files, bits = _summary(spark, snap, key, schema)
    rows = files.agg(F.sum("n").alias("n")).first()["n"] or 0
    names = list(snap.files)
    if keys.count() * len(names) <= max(rows, 1 << 20):
        names = [r["file"] for r in files_that_may_hold(spark, files, bits, keys).collect()]      # file names only
    if not names:
        return []
    held = _keys_with_file(spark, snap, names, key, schema).join(keys, "key", "left_semi").select("file").distinct()
    return sorted(r["file"] for r in held.collect())


def merge(spark: SparkSession, path: str, df: DataFrame, operation: str, key: str = "Id", on_error: str = "fail") -> MergeResult:
    """Apply an update or upsert to the Parquet table at ``path`` and commit it
    as the next version; results are those of :func:`.write.apply_write`.

    ``on_error="fail"`` changes nothing if a row is rejected; ``"skip"`` applies
    the others.  A writer that commits first makes this one fail (nothing
    changes, its new files are in no version).  Without a row to apply, no
    version is made."""
    if operation.lower() not in ("update", "upsert"):
        raise CatalogError(f"Only update and upsert touch files, not '{operation}'")
    policy = error_policy(on_error)
    snap = versions.snapshot(spark, path)
    if not snap.files:
        raise CatalogError(f"There is no table at '{path}'")
    schema = versions.read_files(spark, snap, snap.files[:1]).schema
    names = {f.name.lower(): f.name for f in schema.fields}
    if key.lower() not in names:
        raise CatalogError(f"Key field '{key}' does not exist in the table")
    key = names[key.lower()]
    unknown = [c for c in df.columns if c.lower() not in names]
    if unknown or key.lower() not in [c.lower() for c in df.columns]:
        raise CatalogError(f"Fields {unknown} do not exist in the table" if unknown else f"Key field '{key}' is missing from the input")
    empty = spark.createDataFrame([], schema)
    kept = scratch_path(spark, "merge-input")       # read once, however it is made
    _cast_to(_align(df, empty), empty).write.parquet(kept)
    inp = spark.read.parquet(kept)
    single, _ = _by_key(inp.where(~_blank(inp, key)), key)
    touched = touched_files(spark, snap, single.select(F.col(quote(key)).alias("key")), key, schema)
    result = apply_write(versions.read_files(spark, snap, touched, schema), inp, operation, key, id_field=key)
    bad = result.rejected.select("error").limit(1).collect()
    if bad and policy == "fail":
        raise CatalogError(f"Write to '{path}' rejected rows: {bad[0]['error']}")
    if result.written.isEmpty():
        return MergeResult(snap.version, [], [], len(snap.files), result.rejected)
    added = versions.add_files(spark, path, result.table)
    gone = set(touched)
    done = versions.publish(spark, snap, [*[n for n in snap.files if n not in gone], *added])
    return MergeResult(done.version, touched, added, len(snap.files) - len(touched), result.rejected)
