"""Distributed row numbering and write-batch packing (W-06).

``global_index`` numbers rows in key order without a single-partition
window: rows are range-partitioned and sorted on the key, tagged with
``monotonically_increasing_id`` (partition index in the high bits, position in
the low bits), cut from lineage with a reliable ``checkpoint()`` so the tags
are fixed even if an executor is lost, and shifted by the row counts of the
earlier partitions.  The offset table has one row per partition, so
broadcasting it is bounded by the partition count, not by the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import quote
from ..session import checkpoint_dir, scratch_path

# Batch limits of the sink.
MAX_RECORDS_PER_BATCH = 10_000
MAX_BYTES_PER_BATCH = 10_000_000
_LOW_BITS = (1 << 33) - 1


def _order_cols(df: DataFrame, order: Iterable[str]) -> list[Column]:
    """``order`` plus one tie-breaker: a 64-bit hash of the other columns.
    The order becomes total and repeatable (rows that tie are identical in
    every hashed column), and the keys the range partitioner samples to the
    driver stay small however wide the rows are."""
    keys = list(order)
    rest = [c for c in df.columns if c not in keys
            and not isinstance(df.schema[c].dataType, (T.MapType, T.ArrayType, T.StructType))]
    out = [F.col(quote(c)) for c in keys]
    if rest:
        out.append(F.xxhash64(*[F.col(quote(c)) for c in rest]))
    return out


def global_index(df: DataFrame, order: Iterable, name: str = "index") -> DataFrame:
    """``df`` plus a 0-based row number in ``order`` (column names or sort
    Columns such as ``col.desc_nulls_first()``; ties broken by the other
    columns)."""
    checkpoint_dir(df.sparkSession)
    order = list(order)
    if all(isinstance(o, str) for o in order):
        cols = _order_cols(df, order)
    else:
        cols = [o if isinstance(o, Column) else F.col(quote(o)) for o in order] + _order_cols(df, [])
    if not cols:
        # nothing sortable: a deterministic hash of the row spreads it
        cols = [F.xxhash64(*[F.col(quote(c)) for c in df.columns])]
    tagged = (df.repartitionByRange(*cols).sortWithinPartitions(*cols)
              .withColumn("__mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    part = F.shiftright(F.col("__mid"), 33)
    local = F.col("__mid").bitwiseAND(F.lit(_LOW_BITS))
    counts = tagged.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    return (tagged.join(F.broadcast(offsets), part == F.col("__part"))
            .select(*[F.col(quote(c)) for c in df.columns], (F.col("__off") + local).alias(name)))


def csv_line_bytes(df: DataFrame) -> Column:
    """Bytes of a row as the quote-all CSV line that the writer makes of it:
    each value in its written form (D-03), ``"`` doubled, CRLF end."""
    from .codec import encode_value
    parts = [F.concat(F.lit('"'), F.replace(F.coalesce(encode_value(F.col(quote(f.name)), f), F.lit("")),
                                            F.lit('"'), F.lit('""')), F.lit('"')) for f in df.schema.fields]
    return F.octet_length(F.concat_ws(",", *parts)) + 2


def csv_header_bytes(columns: list[str]) -> int:
    line = ",".join('"' + c.replace('"', '""') + '"' for c in columns)
    return len(line.encode("utf-8")) + 2


def _check_limits(max_records: int, max_bytes: int | None) -> None:
    if not 1 <= max_records <= MAX_RECORDS_PER_BATCH:
        raise ValueError(f"max_records must be between 1 and {MAX_RECORDS_PER_BATCH}")
    if max_bytes is not None and not 1 <= max_bytes <= MAX_BYTES_PER_BATCH:
        raise ValueError(f"max_bytes must be between 1 and {MAX_BYTES_PER_BATCH}")


class GreedyPacker:
    """Sequential batch packing with the writer's rule: before a record,
    close the batch when buffer + record + batch files + record file >
    max_bytes, or when the batch already holds max_records.  The check for
    the first record of an empty batch leaves out the header, and that
    record always enters the batch.  State carries across calls, so one
    packer serves all Arrow chunks of a task.

    Record and file sizes are non-negative, so the bytes of a batch grow with
    each record: the end of a batch is found with one ``searchsorted`` on the
    prefix sums, and the Python loop runs once per batch, not per row."""

    def __init__(self, header: int, max_records: int, max_bytes: int):
        self.header, self.max_records, self.max_bytes = header, max_records, max_bytes
        self.batch = 0
        self.count = 0          # records in the open batch
        self.used = 0           # record + file bytes in the open batch (no header)

    def feed(self, rec_bytes: np.ndarray, file_bytes: np.ndarray) -> np.ndarray:
        rec = np.asarray(rec_bytes, dtype=np.int64)
        files = np.asarray(file_bytes, dtype=np.int64)
        n = len(rec)
        out = np.empty(n, dtype=np.int64)
        if n == 0:
            return out
        if (files > self.max_bytes).any():
            raise ValueError("A file is larger than the byte limit of a write batch")
        csum = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(rec + files, out=csum[1:])
        pos = 0
        while pos < n:
            if self.count == 0:
                # an empty batch always takes the next record
                out[pos] = self.batch
                self.used = int(csum[pos + 1] - csum[pos])
                self.count = 1
                pos += 1
                continue
            room = self.max_bytes - self.header - self.used
            # records pos..end-1 fit while csum[end] - csum[pos] <= room
            end = int(np.searchsorted(csum, csum[pos] + room, side="right")) - 1
            end = max(pos, min(end, n, pos + self.max_records - self.count))
            out[pos:end] = self.batch
            self.used += int(csum[end] - csum[pos])
            self.count += end - pos
            pos = end
            if pos < n:
                self.batch += 1
                self.count = 0
                self.used = 0
        return out


def greedy_batches(rec_bytes, file_bytes, header: int, max_records: int, max_bytes: int) -> np.ndarray:
    """Batch number of each record of one task (see :class:`GreedyPacker`)."""
    return GreedyPacker(header, max_records, max_bytes).feed(np.asarray(rec_bytes), np.asarray(file_bytes))


def pack_batches(df: DataFrame, max_records: int = MAX_RECORDS_PER_BATCH,
                 max_bytes: int | None = None, order_by: Iterable[str] = (),
                 file_bytes: str | None = None, name: str = "batch_id",
                 partition_by: Iterable[str] = ()) -> DataFrame:
    """Assign write batches, numbered from 0 in ``order_by`` order.

    Records cap only: batch = row number // max_records.  With a byte cap the
    packing is greedy over the whole DataFrame in that order
    (:func:`greedy_batch_numbers`), whatever the layout of the tasks.  ``partition_by``
    names columns whose values are packed each on its own instead: batches are
    numbered from 0 within a value; the rows of a value then
    meet in one task.  ``file_bytes`` names a column with attachment sizes
    counted per batch.  Sizes are those of the written CSV text; only they and
    the row numbers go to Python.
    """
    _check_limits(max_records, max_bytes)
    order = list(order_by)
    if max_bytes is None and file_bytes is None:
        if not order:
            raise ValueError("order_by is needed to number batches")
        idx = global_index(df, order, "__idx")
        return idx.select(*[F.col(quote(c)) for c in df.columns],
                          F.floor(F.col("__idx") / max_records).cast("long").alias(name))
    limit = max_bytes or MAX_BYTES_PER_BATCH
    data_cols = [c for c in df.columns if c != file_bytes]
    header = csv_header_bytes(data_cols)
    files = F.coalesce(F.col(quote(file_bytes)), F.lit(0)).cast("long") if file_bytes else F.lit(0).cast("long")
    if partition_by:
        return _pack_each(df, [F.col(quote(c)) for c in partition_by], order, header, max_records, limit, files, data_cols, name)
    idx = global_index(df, order, "__idx")
    fits = F.when(files > limit, F.raise_error(F.lit("A file is larger than the byte limit of a write batch")).cast("long")).otherwise(files)
    sizes = idx.select(F.col("__idx").alias("row"), (csv_line_bytes(idx.select(*[F.col(quote(c)) for c in data_cols])) + fits).cast("long").alias("size"))
    batches = greedy_batch_numbers(sizes, header, max_records, limit)
    joined = idx.join(batches, F.col("__idx") == F.col("row"))
    return joined.select(*[F.col(quote(c)) for c in df.columns], F.col("__batch").alias(name))


def _pack_each(df: DataFrame, own: list[Column], order: list[str], header: int, max_records: int, limit: int,
               files: Column, data_cols: list[str], name: str) -> DataFrame:
    """Packing within each value of ``own``: its rows meet, in order, in one task."""
    laid = df.repartition(*own).sortWithinPartitions(*own, *_order_cols(df, order))
    staged = (laid.withColumn("__own", F.struct(*own).cast("string")).withColumn("__rb", csv_line_bytes(df.select(*[F.col(quote(c)) for c in data_cols])))
              .withColumn("__fb", files))
    out_schema = T.StructType(staged.schema.fields + [T.StructField(name, T.LongType(), False)])

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer, current = GreedyPacker(header, max_records, limit), None
        for pdf in batches:
            keys, ids = pdf["__own"].to_numpy(), np.empty(len(pdf), np.int64)
            cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
            for a, b in zip(cuts, np.append(cuts[1:], len(keys))):
                if keys[a] != current:
                    packer, current = GreedyPacker(header, max_records, limit), keys[a]
                ids[a:b] = packer.feed(pdf["__rb"].to_numpy()[a:b], pdf["__fb"].to_numpy()[a:b])
            yield pdf.assign(**{name: ids})

    return staged.mapInPandas(pack, out_schema).drop("__own", "__rb", "__fb")


# ---------------------------------------------------- greedy packing in blocks
#: rows of a block, at least; blocks composed in one task
BLOCK_ROWS, FAN = 1 << 14, 64


def next_starts(sizes: np.ndarray, room: int, max_records: int) -> np.ndarray:
    """For each row the row with which the next batch begins if one begins
    here: at least one row on, at most ``max_records``, and as far as the rows'
    sizes sum up to ``room``."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    rows = np.arange(len(sizes))
    full = np.searchsorted(before, before[:-1] + room, side="right") - 1
    return np.minimum(np.maximum(full, rows + 1), rows + max_records)


def block_exits(following: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """For each of a block's first ``own`` rows: the first batch start behind
    the block if a batch starts here, and how many batches start until then.
    Pointers are doubled: a round takes each as far as its target has come."""
    at, steps = following[:own].copy(), np.ones(own, np.int64)
    while True:
        inside = np.flatnonzero(at < own)
        if not len(inside):
            return at, steps
        steps[inside] += steps[at[inside]]      # both sides of the round before: fancy indexing copies first
        at[inside] = at[at[inside]]


def runs(exits: np.ndarray, steps: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal neighbours joined: where each run begins, its exit, its steps.
    Starts that differ soon fall on one exit, so the runs are few."""
    new = np.flatnonzero(np.concatenate([[True], (np.diff(exits) != 0) | (np.diff(steps) != 0)]))
    return first[new], exits[new], steps[new]


def greedy_batch_numbers(sizes: DataFrame, header: int, max_records: int, max_bytes: int) -> DataFrame:
    """(row, __batch) of the writer's greedy rule over rows numbered from 0
    without gaps, with their ``size``.

    Rows are cut into blocks so long that a batch reaches the next block at most.
    A block is a step function from the row at which its first own batch starts to
    the same of the next block; a tree composes the functions of neighbouring
    blocks, and from its root the starts go down again to every block, which then
    numbers its rows.  A task holds two blocks of sizes, or the functions of
    ``FAN`` blocks; ids depend on the rows' order alone."""
    spark = sizes.sparkSession
    length = max_records * -(-BLOCK_ROWS // max_records)
    room = max_bytes - header
    block = F.expr(f"row div {length}")
    both = sizes.select("row", "size", F.explode(F.array(block, block - 1)).alias("block")).where("block >= 0")

    def pointers(table: pa.Table, block_id: int) -> tuple[int, np.ndarray, int]:
        rows = table.column("row").to_numpy()
        order = np.argsort(rows)
        own = int(np.count_nonzero(rows < (block_id + 1) * length))
        return own, next_starts(table.column("size").to_numpy()[order], room, max_records), block_id * length

    def function_of(key, table):
        block_id = key[0].as_py()
        own, following, first = pointers(table, block_id)
        if not own:         # the rows of block 0 have no block before
            return pa.table({c: pa.array([], t) for c, t in zip(("block", "low", "exit", "steps"), [pa.int64(), *[pa.binary()] * 3])})
        exits, steps = block_exits(following, own)
        low, exits, steps = runs(exits + first, steps, np.arange(own) + first)
        return _function_row(block_id, low, exits, steps)

    shape = "block long, low binary, exit binary, steps binary"
    levels = [_staged(both.groupBy("block").applyInArrow(function_of, shape), "pack-blocks")]
    blocks = levels[0].count()
    while blocks > 1:
        parent = levels[-1].withColumn("parent", F.expr(f"block div {FAN}"))
        levels.append(_staged(parent.groupBy("parent").applyInArrow(_composed, shape), "pack-blocks"))
        blocks = -(-blocks // FAN)
    entry_shape = "block long, entry long, batch long"
    entries = spark.createDataFrame([(0, 0, 0)], entry_shape)
    for level in reversed(levels[:-1]):
        children = level.withColumn("parent", F.expr(f"block div {FAN}"))
        entries = children.groupBy("parent").cogroup(entries.groupBy("block")).applyInArrow(_entries_of, entry_shape)

    def numbered(key, table, entry):
        block_id = key[0].as_py()
        own, following, first = pointers(table, block_id)
        start = np.zeros(own, bool)
        at = entry.column("entry")[0].as_py() - first if own and entry.num_rows else own
        while at < own:     # once a batch
            start[at] = True
            at = int(following[at])
        batch = np.cumsum(start) + (entry.column("batch")[0].as_py() - 1 if entry.num_rows else 0)
        return pa.table({"row": pa.array(np.arange(own) + first), "__batch": pa.array(batch.astype(np.int64))})
    return both.groupBy("block").cogroup(entries.groupBy("block")).applyInArrow(numbered, "row long, __batch long")


def _staged(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _function_row(block: int, *arrays: np.ndarray) -> pa.Table:
    return pa.table({"block": pa.array([block], pa.int64()),
                     **{c: pa.array([a.astype(np.int64).tobytes()], pa.binary()) for c, a in zip(("low", "exit", "steps"), arrays)}})


def _functions(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The functions of a table's blocks, in their order."""
    rows = [(r["block"], *[np.frombuffer(r[c], np.int64) for c in ("low", "exit", "steps")]) for r in table.to_pylist()]
    return sorted(rows, key=lambda r: r[0])


def _composed(key, table):
    """The blocks of one parent as one function."""
    some = _functions(table)
    _, low, exits, steps = some[0]
    for _, next_low, next_exit, next_steps in some[1:]:
        at = np.searchsorted(next_low, exits, side="right") - 1
        low, exits, steps = runs(next_exit[at], steps + next_steps[at], low)
    return _function_row(key[0].as_py(), low, exits, steps)


def _entries_of(key, children, parent):
    """Where the first batch of each child block starts, and its number."""
    out = []
    entry, batch = parent.column("entry")[0].as_py(), parent.column("batch")[0].as_py()
    for block, low, exits, steps in _functions(children):
        out.append((block, entry, batch))
        at = int(np.searchsorted(low, entry, side="right")) - 1
        entry, batch = int(exits[at]), batch + int(steps[at])
    return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("block", "entry", "batch"), zip(*out))})


def check_packing(packed: DataFrame, data_cols: list[str], order_col: str, max_records: int,
                  max_bytes: int, batch_col: str = "batch_id", file_bytes: str | None = None) -> DataFrame:
    """One row (n_rows, violations) over a packed DataFrame: a batch breaks a
    cap (records, or bytes with the header when it holds more than one
    record), or is closed early although the first record of the next batch
    would have fitted (not greedy).  Work is one aggregate per batch and a join
    of each batch with the next."""
    header = csv_header_bytes(data_cols)
    size = csv_line_bytes(packed.select(*[F.col(quote(c)) for c in data_cols]))
    if file_bytes:
        size = size + F.coalesce(F.col(quote(file_bytes)), F.lit(0))
    per_batch = (packed.withColumn("__rb", size).groupBy(batch_col)
                 .agg(F.count(F.lit(1)).alias("n"), F.sum("__rb").alias("bytes"),
                      F.min_by("__rb", F.col(quote(order_col))).alias("first_bytes")))
    after = per_batch.select((F.col(batch_col) - 1).alias(batch_col), F.col("first_bytes").alias("next_first"))
    checked = per_batch.join(after, batch_col, "left")
    over = (F.col("n") > max_records) | ((F.lit(header) + F.col("bytes") > max_bytes) & (F.col("n") > 1))
    not_greedy = (F.col("next_first").isNotNull() & (F.col("n") < max_records)
                  & (F.lit(header) + F.col("bytes") + F.col("next_first") <= max_bytes))
    return checked.agg(F.sum("n").alias("n_rows"), F.count_if(over | not_greedy).alias("violations"))
