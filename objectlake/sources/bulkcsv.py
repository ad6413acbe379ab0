"""Bulk result CSV source (S-07, U-02): quoted UTF-8 CSV files with a header
each, read as one typed rowset.

Files of any size are read by many tasks.  Spark hands out their lines in blocks; a
line end inside quotes is no record end, and whether a block begins inside quotes
follows from the number of quotes before it.  So a first pass counts the quotes of
each chunk of lines and takes each file's header; sums over a file's chunks (a few
numbers each, not their text) say how every chunk begins.  The second pass cuts the chunks at
true record ends and reads their records by the file's own header; the pieces of
a record that crosses chunks are brought together by its number and read last.
"""

from __future__ import annotations

import csv
import io
import sys
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogError
from ..naming import normalize_name
from ..operators.codec import decode
from ..session import scratch_path

#: characters of a chunk of lines, about
CHUNK = 4 << 20
_PLACE = ["file", "start", "seq"]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The files' lines with their file (a hash of its path) and block."""
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _chunks(batches):
    """(file, start, seq, text) of the lines of a task: the lines of one block
    that begin in its same ``CHUNK`` bytes, each with its line end."""
    block, place, offset, held = None, None, 0, []
    for b in batches:
        if not b.num_rows:
            continue
        lines = b.column("value")
        begins = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4).astype(np.int64) + np.arange(len(lines) + 1)
        where = np.stack([b.column("file").to_numpy(), b.column("start").to_numpy()], 1)
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(1)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(lines)]):
            here = tuple(where[low].tolist())
            if here != block:
                block, offset = here, 0
            seqs = (offset + begins[low:high] - begins[low]) // CHUNK
            offset += int(begins[high] - begins[low])
            changes = [0, *(np.flatnonzero(np.diff(seqs)) + 1), high - low]
            for x, y in zip(changes, changes[1:]):
                if place != (*block, int(seqs[x])):
                    if held:
                        yield (*place, "".join(held))
                    place, held = (*block, int(seqs[x])), []
                held.append(pc.binary_join(pa.ListArray.from_arrays([0, y - x], lines.slice(low + x, y - x)), "\n")[0].as_py() + "\n")
    if held:
        yield (*place, "".join(held))


def record_ends(text: str, inside: bool) -> np.ndarray:
    """Byte positions behind the record ends of ``text`` (UTF-8), which begins inside quotes or not."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    quotes = np.cumsum(raw == 34) & 1
    return np.flatnonzero((raw == 10) & (quotes == int(inside))) + 1


def _counted(batches):
    """The first pass: of each chunk the parity of its quotes, whether it has
    record ends if it begins outside and inside quotes, and the header of a file's first one."""
    for file, start, seq, text in _chunks(batches):
        out, ins = record_ends(text, False), record_ends(text, True)
        header = text.encode("utf-8")[:int(out[0])].decode("utf-8") if start == 0 and seq == 0 and len(out) else None
        yield pa.RecordBatch.from_pydict(
            {"file": [file], "start": [start], "seq": [seq], "odd": [text.count('"') & 1], "ends_out": [bool(len(out))],
             "ends_in": [bool(len(ins))], "header": [header]}, _schema(_COUNTED))


_COUNTED = [("file", pa.int64()), ("start", pa.int64()), ("seq", pa.int32()), ("odd", pa.int32()), ("ends_out", pa.bool_()),
            ("ends_in", pa.bool_()), ("header", pa.string())]
_PIECES = [("number", pa.int64()), ("piece", pa.string()), ("header", pa.string()), ("file", pa.int64()), ("start", pa.int64()), ("seq", pa.int32())]
_BODIES = [("file", pa.int64()), ("start", pa.int64()), ("seq", pa.int32()), ("body", pa.string())]


def _schema(fields) -> pa.Schema:
    return pa.schema([pa.field(n, t) for n, t in fields])


def _rows(text: str, header: str, wanted: list[str]):
    """The records of ``text`` as columns in the order of ``wanted`` (names
    normalised, lower case), by the names of ``header``."""
    csv.field_size_limit(sys.maxsize)
    names = [normalize_name(n).lower() for n in next(csv.reader(io.StringIO(header.removeprefix("\ufeff"), newline="")))]
    at = {n: i for i, n in enumerate(names)}
    rows = [r for r in csv.reader(io.StringIO(text, newline=""), strict=True) if r]
    for r in rows:
        if len(r) != len(names):
            raise ValueError(f"A record has {len(r)} values, its header {len(names)}: {str(r)[:200]}")
    return [[r[at[w]] for r in rows] if w in at else [None] * len(rows) for w in wanted]


def read_bulk_results(spark: SparkSession, paths: str | list[str], schema: T.StructType,
                      strict: bool = True) -> DataFrame:
    """Read result files (header per file, whose names say which column is
    which; a header-only file adds no rows; an empty file is an error; quoted newlines,
    commas and doubled quotes are kept) and decode them to ``schema`` (D-01).

    The first pass runs when this is called; it finds files without a header."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths)
    kept = scratch_path(spark, "csv-chunks")
    lines.mapInArrow(_counted, "file long, start long, seq int, odd int, ends_out boolean, ends_in boolean, header string").write.parquet(kept)
    counted = spark.read.parquet(kept)
    # Spark's listing names empty files, its scan passes over them
    something = r"[^ \\t\\r\\n]"
    listed, seen = len(lines._jdf.inputFiles()), counted.where(f"header rlike '{something}'").count()
    if listed != seen:
        filled = counted.where(f"header rlike '{something}'").select("file")
        names = spark.createDataFrame([(f, unquote(f).replace("file:///", "file:/")) for f in lines.inputFiles()], "name string, plain string")
        read = spark.read.text(paths).select(F.col("_metadata.file_path").alias("path")).distinct().select("path", F.xxhash64("path").alias("file"))
        good = read.join(filled, "file", "left_semi").select(F.replace(F.url_decode("path"), F.lit("file:///"), F.lit("file:/")).alias("plain"))
        raise CatalogError(f"Result file '{names.join(good, 'plain', 'left_anti').first()['name']}' has no header")

    before = Window.partitionBy("file").orderBy("start", "seq").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.select(*_PLACE, "ends_out", "ends_in", F.max("header").over(Window.partitionBy("file")).alias("header"),
                           (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    has_end = F.when(F.col("inside"), F.col("ends_in")).otherwise(F.col("ends_out"))
    # the record that is open when a chunk begins is numbered by the chunks with a record end before it
    told = begun.select(*_PLACE, "header", "inside", F.coalesce(F.sum(has_end.cast("long")).over(before), F.lit(0)).alias("number"))

    wanted = [normalize_name(f.name).lower() for f in schema.fields]
    columns = [f"c{i}" for i in range(len(wanted))]
    texts = ", ".join(f"{c} string" for c in columns)

    def table(values: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array(v, pa.string()) for c, v in zip(columns, values)})

    def bodies(batches):
        for file, start, seq, text in _chunks(batches):
            yield pa.RecordBatch.from_pydict({"file": [file], "start": [start], "seq": [seq], "body": [text]}, _schema(_BODIES))

    def parts(row: dict) -> tuple[bytes, int, int, bool]:
        """A chunk's bytes, where its whole records begin and end, and whether
        it has a record end.  What stands before the first one belongs to the record that
        was open (a file's first record is its header)."""
        raw, ends = row["body"].encode("utf-8"), record_ends(row["body"], row["inside"])
        opened = row["inside"] or (row["start"] == 0 and row["seq"] == 0)
        return raw, int(ends[0]) if len(ends) and opened else 0, int(ends[-1]) if len(ends) else 0, len(ends) > 0

    def whole_records(batches):
        for b in batches:
            for row in b.to_pylist():
                raw, head, tail, _ = parts(row)
                if head < tail:
                    yield table(_rows(raw[head:tail].decode("utf-8"), row["header"], wanted))

    def pieces(batches):
        for b in batches:
            for row in b.to_pylist():
                raw, head, tail, ended = parts(row)
                found = [(row["number"], raw[:head])] if row["inside"] and head else []
                if tail < len(raw):
                    found.append((row["number"] + ended, raw[tail:]))
                for number, piece in found:
                    yield pa.RecordBatch.from_pydict({"number": [number], "piece": [piece.decode("utf-8")], **{c: [row[c]] for c in ("header", *_PLACE)}},
                                                     _schema(_PIECES))

    def crossing_records(batches):
        for b in batches:
            for row in b.to_pylist():
                yield table(_rows(row["text"], row["header"], wanted))
    # a chunk that the first pass has not met means other blocks: its settings have changed since
    same = F.when(F.col("number").isNull(), F.raise_error(F.lit("The files or spark.sql.files.maxPartitionBytes changed since read_bulk_results"))
                  .cast("long")).otherwise(F.col("number"))
    chunks = lines.mapInArrow(bodies, "file long, start long, seq int, body string").join(told, _PLACE, "left").withColumn("number", same)
    some = chunks.mapInArrow(pieces, "number long, piece string, header string, file long, start long, seq int")
    joined = some.groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "piece"))).alias("p"), F.first("header").alias("header"))
    crossing = joined.select("header", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("text")).mapInArrow(crossing_records, texts)
    found = chunks.mapInArrow(whole_records, texts).unionByName(crossing)
    return decode(found.toDF(*[f.name for f in schema.fields]), schema, strict)

