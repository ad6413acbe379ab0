"""Writes into object tables: insert, update, upsert (W-01..W-05, W-09, W-11, W-12).

A write is a pure DataFrame transform from (target table, input rows) to
(new table, written rows, rejected rows); ``commit`` then stages the new
table in shared storage and swaps it in, so a failed job leaves the old table
untouched and task retries cannot duplicate rows (Spark's output committer).

Joins are on the key only; duplicates of a key in the input are found with
a partial aggregate (map-side combine) rather than a window, so a key holding
a third of the input costs one small aggregate row, not one huge task.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogError
from ..naming import quote

# Operations and error policies (short names and the option
# texts "Skip on error" and "Fail on error").
OPERATIONS = ("insert", "update", "upsert")
ERROR_POLICIES = ("skip", "fail")
ERROR_POLICY_TEXTS = {"skip": "skip", "fail": "fail", "skip on error": "skip", "fail on error": "fail"}


def error_policy(value: str) -> str:
    """``skip`` or ``fail`` from either spelling, any case; anything else is
    refused rather than silently read as ``fail``."""
    policy = ERROR_POLICY_TEXTS.get(str(value).strip().lower())
    if policy is None:
        raise CatalogError(f"Unknown error handling '{value}'; expected skip or fail")
    return policy


@dataclass
class WriteResult:
    table: DataFrame       # the object table after the write
    written: DataFrame     # input rows applied
    rejected: DataFrame    # input rows refused, with an ``error`` column


def _c(name: str):
    return F.col(quote(name))


def validate_write(target_schema: T.StructType, input_schema: T.StructType, operation: str,
                   key: str | None = None, id_field: str = "Id", external_ids: Iterable[str] = (),
                   read_only: Iterable[str] = (), check_types: bool = False) -> list[str]:
    """W-04/W-05/W-11: every failure, not just the first."""
    failures = []
    op = operation.lower()
    if op not in OPERATIONS:
        return [f"Unknown operation '{operation}'; expected one of {', '.join(OPERATIONS)}"]
    tfields = {f.name.lower(): f for f in target_schema.fields}
    ext = {e.lower() for e in external_ids} | {id_field.lower()}
    ro = {r.lower() for r in read_only}
    if not input_schema.fields:
        failures.append("At least one field is needed")
    if op == "upsert":
        if not key:
            failures.append("Upsert needs a key field")
        else:
            if key.lower() not in tfields:
                failures.append(f"Key field '{key}' does not exist in the object")
            elif key.lower() not in ext:
                failures.append(f"Key field '{key}' is not an external id or the Id")
            if key.lower() not in {f.name.lower() for f in input_schema.fields}:
                failures.append(f"Key field '{key}' is missing from the input")
    elif key:
        failures.append(f"A key field is only allowed for upsert, not {op}")
    if op == "update" and id_field.lower() not in {f.name.lower() for f in input_schema.fields}:
        failures.append(f"Update needs the '{id_field}' field in the input")
    for f in input_schema.fields:
        n = f.name.lower()
        # only the operation's own key is exempt: the Id of an update, the key of an upsert
        if n == (id_field.lower() if op == "update" else (key or "").lower()):
            continue
        if n not in tfields or n in ro:
            failures.append(f"Field '{f.name}' is not creatable or updatable in the object")
        elif check_types and tfields[n].dataType != f.dataType:
            failures.append(f"Field '{f.name}' is {f.dataType.simpleString()}, "
                            f"object has {tfields[n].dataType.simpleString()}")
    return failures


def _align(df: DataFrame, target: DataFrame) -> DataFrame:
    """W-11: input columns renamed to the target's case."""
    names = {c.lower(): c for c in target.columns}
    return df.select(*[_c(c).alias(names.get(c.lower(), c)) for c in df.columns])


def _blank(df: DataFrame, key: str):
    """A missing key: null, or empty text for a string key."""
    k = _c(key)
    if isinstance(df.schema[key].dataType, T.StringType):
        return k.isNull() | (k == "")
    return k.isNull()


def _by_key(keyed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """One partial aggregate per key: the rows whose key occurs once (the row
    itself, taken from the aggregate) and the keys that repeat.  A key held by
    a third of the input combines map-side into one row per task."""
    others = [c for c in keyed.columns if c != key]
    aggs = [F.count(F.lit(1)).alias("__n")]
    if others:
        aggs.append(F.first(F.struct(*[_c(c) for c in others])).alias("__row"))
    stats = keyed.groupBy(_c(key).alias(key)).agg(*aggs)
    single = stats.filter(F.col("__n") == 1).select(_c(key), *[F.col("__row")[c].alias(c) for c in others])
    repeated = stats.filter(F.col("__n") > 1).select(_c(key).alias("__dk"))
    return single, repeated


def _with_error(df: DataFrame, msg: str) -> DataFrame:
    return df.withColumn("error", F.lit(msg))


def _refused(inp: DataFrame, keyed: DataFrame, tkeys: DataFrame, key: str) -> DataFrame:
    """The rows that an update refuses, each labelled once: a key's verdict comes
    from its count and one existence test in the target, and the rows meet it in a left
    join (which AQE splits for a hot key, and which rows without a key pass)."""
    known = tkeys.where(F.col("__tk") == F.col("__dk").outer()).exists()
    verdict = (keyed.groupBy(_c(key).alias("__dk")).agg(F.count(F.lit(1)).alias("__n")).where((F.col("__n") > 1) | ~known)
               .select("__dk", F.when(F.col("__n") > 1, F.lit(f"Duplicate {key} in the input"))
                       .otherwise(F.lit(f"{key} does not exist")).alias("error")))
    labelled = inp.join(verdict, _c(key) == F.col("__dk"), "left")
    error = F.when(_blank(inp, key), F.lit(f"{key} is missing")).otherwise(F.col("error"))
    return labelled.select(*[_c(c) for c in inp.columns], error.alias("error")).where("error is not null")


def _apply_updates(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Target rows with the supplied columns of matching update rows; columns
    absent from the input keep their values, a supplied null sets null.
    Update keys are unique, so the join adds no rows."""
    supplied = [c for c in updates.columns if c != key and c in target.columns]
    u = updates.select(_c(key).alias("__uk"), *[_c(c).alias(f"__u_{c}") for c in supplied],
                       F.lit(True).alias("__hit"))
    joined = target.join(u, _c(key) == F.col("__uk"), "left")
    return joined.select(*[
        (F.when(F.col("__hit"), F.col(quote(f"__u_{c}"))).otherwise(_c(c)).alias(c) if c in supplied else _c(c))
        for c in target.columns])


def _merge(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Upsert in one full outer join (keys are unique on both sides, so there
    is no skew to split): matched rows take the supplied columns, unmatched
    input rows become new rows, the rest of the target is kept."""
    supplied = [c for c in updates.columns if c != key and c in target.columns]
    t = target.select(*[_c(c) for c in target.columns])
    u = updates.select(_c(key).alias("__uk"), *[_c(c).alias(f"__u_{c}") for c in supplied],
                       F.lit(True).alias("__hit"))
    j = t.join(u, _c(key) == F.col("__uk"), "full")
    hit = F.coalesce(F.col("__hit"), F.lit(False))
    cols = []
    for c in target.columns:
        if c == key:
            cols.append(F.coalesce(_c(c), F.col("__uk").cast(target.schema[c].dataType)).alias(c))
        elif c in supplied:
            cols.append(F.when(hit, F.col(quote(f"__u_{c}"))).otherwise(_c(c)).alias(c))
        else:
            cols.append(_c(c))
    return j.select(*cols)


def _cast_to(df: DataFrame, target: DataFrame) -> DataFrame:
    types = {f.name: f.dataType for f in target.schema.fields}
    return df.select(*[_c(c).cast(types[c]).alias(c) if c in types else _c(c) for c in df.columns])


def apply_write(target: DataFrame, df: DataFrame, operation: str, key: str | None = None,
                id_field: str = "Id") -> WriteResult:
    """W-01 insert, W-02 update (by ``id_field``), W-03 upsert (by ``key``).

    The new table reads the target once and the input once; the written and
    rejected row sets are separate lazy DataFrames, computed only if used."""
    op = operation.lower()
    inp = _cast_to(_align(df, target), target)
    empty = inp.limit(0).withColumn("error", F.lit(None).cast("string"))
    if op == "insert":
        table = target.unionByName(inp, allowMissingColumns=True).select(*target.columns)
        return WriteResult(table, inp, empty)
    k = id_field if op == "update" else (key or id_field)
    if op not in ("update", "upsert"):
        raise CatalogError(f"Unknown operation '{operation}'")
    keyed = inp.filter(~_blank(inp, k))
    single, repeated = _by_key(keyed, k)
    if op == "update":
        tkeys = target.select(_c(k).alias("__tk"))
        found = single.join(tkeys, _c(k) == F.col("__tk"), "left_semi")
        return WriteResult(_apply_updates(target, single, k), found, _refused(inp, keyed, tkeys, k))
    dups = _with_error(keyed.join(repeated, _c(k) == F.col("__dk"), "left_semi"), f"Duplicate {k} in the input")
    blank = inp.filter(_blank(inp, k))
    # upsert: a row without a key is inserted as given
    table = _merge(target, single, k).unionByName(blank, allowMissingColumns=True).select(*target.columns)
    return WriteResult(table, single.unionByName(blank), dups)


def write(catalog, obj: str, df: DataFrame, operation: str, key: str | None = None,
          on_error: str = "fail", check_types: bool = False) -> WriteResult:
    """Validate and apply a write to a catalog object (W-04, W-05, W-09).

    ``on_error="fail"`` raises when any row is rejected (nothing may be
    committed); ``"skip"`` keeps the good rows and returns the rejected ones.
    """
    on_error = error_policy(on_error)
    o = catalog.get(obj)
    target = catalog.table(obj)
    failures = validate_write(target.schema, df.schema, operation, key, o.id_field or "Id",
                              o.external_ids, o.read_only, check_types)
    if failures:
        raise CatalogError("; ".join(failures), failures)
    res = apply_write(target, df, operation, key, o.id_field or "Id")
    if on_error == "fail":
        bad = res.rejected.select("error").limit(1).collect()
        if bad:
            raise CatalogError(f"Write to '{o.name}' rejected rows: {bad[0]['error']}")
    return res


def commit(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | list[str] | None = None) -> str:
    """W-12: write to a staging folder next to ``path``, then swap it in.

    The old table stays in place until the new one is complete; the swap is
    two renames on the table's file system (:func:`swap`).  ``partition_by``
    keeps a partitioned layout (folders per value, pruned by filters on read)."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.__staging-{uuid.uuid4().hex[:12]}"
    w = df.write.format(fmt).mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dst = jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(conf)
    try:
        w.save(staging)
    except Exception:
        # abort: the target is untouched; drop our own half-written staging folder
        fs.delete(jvm.org.apache.hadoop.fs.Path(staging), True)
        raise
    swap(fs, jvm.org.apache.hadoop.fs.Path, staging, path)
    return path


def swap(fs, make_path, staging: str, path: str) -> None:
    """Put the complete folder ``staging`` in the place of ``path``.

    Both renames are checked.  If the new folder does not arrive, or lands
    inside a folder that another writer put there meanwhile, the old table is
    moved back (or left beside it under its ``__previous`` name, which the error
    gives) and nothing of it is deleted; it goes only when the new one is in
    place."""
    dst, new = make_path(path), make_path(staging)
    old = make_path(f"{path.rstrip('/')}.__previous-{uuid.uuid4().hex[:12]}")
    nested = make_path(f"{path.rstrip('/')}/{staging.rstrip('/').rpartition('/')[2]}")
    had = fs.exists(dst)
    if had and not fs.rename(dst, old):
        raise CatalogError(f"The table '{path}' could not be set aside; it is unchanged, the new one is at '{staging}'")
    if fs.rename(new, dst) and fs.exists(dst) and not fs.exists(nested):
        if had:
            fs.delete(old, True)
        return
    if fs.exists(nested):       # moved into another writer's folder: take it out again
        fs.rename(nested, new)
    if had and not fs.exists(dst) and fs.rename(old, dst):
        raise CatalogError(f"The new table could not be put at '{path}'; the old one is back, the new one is at '{staging}'")
    raise CatalogError(f"The new table could not be put at '{path}'" + (f"; the old one is at '{old}'" if had else "")
                       + f", the new one at '{staging}'")


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | list[str] | None = None) -> str:
    """Insert without rewriting: the rows become further files of the table at
    ``path``, all of them or none (Spark's job commit); old files stay as they are."""
    w = df.write.format(fmt).mode("append")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path)
    return path
