"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objectlake.session import scratch_path

#: a word is a run of characters other than the ASCII white space
WORD = r"[^\x20\x09-\x0D]+"

#: md5 digits taken by ``hash52``: 13 hex digits, 52 bits, exact in a double
HASH_RANGE = 2.0 ** 52


#: bytes of a batch of rows between Spark and a Python worker, where the session sets none
BATCH_BYTES = "4m"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact name and position, so further
    columns (also ones that differ by case, or repeat) can't clash."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)      # texts make batches of 10,000 rows large
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; the table has {df.columns}")
    at = {n: df.columns.index(n) for n in names}
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{at[n]}").alias(n) for n in names])


def stage(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared checkpoint folder and read
    again: it cuts lineage, survives lost executors, and gives the planner
    real sizes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: modules whose tasks keep something in the worker for the next task of their stage
KEEPERS = {"objectlake.llm.pieces": "_ENCODERS", "objectlake.llm.token_spans": "_ENCODINGS"}


def give_back() -> None:
    """Return the worker's unused memory to the system: a worker outlives its
    tasks and stages, and what one of them needed should not count in the next."""
    import ctypes
    import gc

    import pyarrow as pa
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not this C library
        pass


def lean(run):
    """An Arrow iterator function that starts without what other stages kept
    in the worker, and gives back its own memory when it ends."""
    import functools

    @functools.wraps(run)
    def leaner(*args):
        import sys
        left = [getattr(sys.modules[module], kept) for module, kept in KEEPERS.items() if module in sys.modules]
        if any(left):
            for kept in left:
                kept.clear()
            give_back()
        try:
            yield from run(*args)
        finally:
            give_back()
    return leaner


def hash52(*parts: Column) -> Column:
    """A uniform 52-bit integer from the parts' text (md5, so that any SQL
    engine can repeat it); null parts count as the text ``null``."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def chunks(batches, column: str, limit: int = 4 << 20):
    """Arrow batches cut so that ``column`` holds at most about ``limit``
    bytes a piece (a longer single value is a piece of its own): the memory of
    a step then follows ``limit`` and the longest text, not the batch size."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
            offsets = np.frombuffer(col.buffers()[1], dtype=np.int32, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
        else:
            offsets = np.frombuffer(col.buffers()[1], dtype=np.int64, count=len(col) + 1 + col.offset)[col.offset:]
        at = 0
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            end = min(max(end, at + 1), batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def ranges(starts, lengths):
    """The numbers starts[0], starts[0]+1, ... (lengths[0] of them), then the
    same for the next pair: the gather index of consecutive runs."""
    import numpy as np
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.asarray(starts, dtype=np.int64) - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)
