"""CSV batch sink (W-07, W-10) and result checks (W-08)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import CatalogError
from ..naming import quote
from ..operators.codec import encode_value


def write_csv_batches(df: DataFrame, path: str, batch_col: str = "batch_id",
                      serial: bool = False, order_by=()) -> None:
    """One quoted UTF-8 CSV file with a header per batch: rows are encoded
    (D-03), shuffled so each batch lands in one task, and written under
    ``<batch_col>=<id>/``.  ``serial`` sorts each task's batches so they are
    written one after another in batch order; the default writes in parallel.
    ``order_by`` (columns of ``df``) is the order of the rows within a file."""
    body = df.select(*[encode_value(F.col(quote(f.name)), f).alias(f.name)
                       for f in df.schema.fields if f.name != batch_col], F.col(quote(batch_col)))
    order = list(order_by)
    if order:
        # sorted on the typed values, which the text would not sort like
        keys = [F.col(quote(c)).alias(f"__order{i}") for i, c in enumerate(order)]
        body = df.select(*[encode_value(F.col(quote(f.name)), f).alias(f.name) for f in df.schema.fields if f.name != batch_col],
                         F.col(quote(batch_col)), *keys)
        out = body.repartition(batch_col).sortWithinPartitions(batch_col, *[f"__order{i}" for i in range(len(order))])
        out = out.drop(*[f"__order{i}" for i in range(len(order))])
    else:
        out = body.repartition(batch_col)
        if serial:
            out = out.sortWithinPartitions(batch_col)
    (out.write.mode("errorifexists").partitionBy(batch_col)
     .option("header", True).option("quoteAll", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("encoding", "UTF-8").csv(path))


def check_results(results: DataFrame, on_error: str = "fail") -> tuple[DataFrame, DataFrame]:
    """W-08: result rows (Id, Success, Created, Error).  Any row whose
    ``Success`` is not ``true`` (any case) is a failure: ``fail`` raises with
    the first error, ``skip`` returns (succeeded, failed)."""
    from .write import error_policy
    on_error = error_policy(on_error)
    ok_cond = F.coalesce(F.lower(F.col("Success")) == "true", F.lit(False))
    good, bad = results.filter(ok_cond), results.filter(~ok_cond)
    if on_error == "fail":
        first = bad.select("Id", "Error").limit(1).collect()
        if first:
            raise CatalogError(f"Record '{first[0]['Id']}' failed: {first[0]['Error']}")
    return good, bad


def write_batched(df: DataFrame, path: str, order_by, max_records: int = 10_000,
                  max_bytes: int | None = None, serial: bool = False,
                  file_bytes: str | None = None) -> None:
    """The batch side of a write (§3.2): pack rows into batches by record
    count (and bytes, greedily per task) in ``order_by`` order, then write one
    quoted CSV file with a header per batch under ``path``, its rows in that
    order.  ``file_bytes`` names the column with the size of a row's attached
    files, which counts in the byte limit and is not written itself."""
    from ..operators.packing import pack_batches
    packed = pack_batches(df, max_records=max_records, max_bytes=max_bytes, order_by=list(order_by),
                          file_bytes=file_bytes)
    if file_bytes:
        packed = packed.drop(file_bytes)
    write_csv_batches(packed, path, serial=serial, order_by=order_by)
