"""Table folders with versions: which data files a reader sees is one list.

A version is a text file ``_versions/v<number>`` that names the table's data
files, a line each.  A commit writes new files into a folder of its own
(``commit-<id>``), then puts its list in place by one rename; readers take the
highest version's list when they plan, and files that a commit replaces stay until
:func:`expire`.  So a reader sees the table before or after a commit, never
between, and a failed or retried job leaves nothing that is listed.  A folder
without ``_versions`` is version 0: all its data files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..catalog import CatalogError

FOLDER = "_versions"


@dataclass(frozen=True)
class Snapshot:
    path: str
    version: int
    files: tuple[str, ...]      # names below ``path``

    def full(self, names: Iterable[str] | None = None) -> list[str]:
        return [f"{self.path}/{n}" for n in (self.files if names is None else names)]


def _fs(spark: SparkSession, path: str):
    """The folder's file system and a maker of its paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _data_files(fs, make, path: str, below: str = "") -> list[str]:
    """Data files directly in ``path``/``below`` (names that Spark reads: no ``_`` or ``.`` before them)."""
    at = make(f"{path}/{below}" if below else path)
    if not fs.exists(at):
        return []
    names = [(s.getPath().getName(), s.isFile(), s.getLen()) for s in fs.listStatus(at)]
    if any(not plain and "=" in n for n, plain, _ in names):
        raise CatalogError(f"The table '{path}' is partitioned by folders; versions hold plain folders only")
    return sorted(f"{below}/{n}" if below else n for n, plain, size in names if plain and size and not n.startswith(("_", ".")))


def is_versioned(spark: SparkSession, path: str) -> bool:
    fs, make = _fs(spark, path)
    return fs.exists(make(f"{path.rstrip('/')}/{FOLDER}"))


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The latest version of the table at ``path``, or the one named."""
    path = path.rstrip("/")
    fs, make = _fs(spark, path)
    folder = make(f"{path}/{FOLDER}")
    known = sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(folder)
                   if s.getPath().getName().startswith("v")) if fs.exists(folder) else []
    if not known and version in (None, 0):
        return Snapshot(path, 0, tuple(_data_files(fs, make, path)))
    if version is not None and version not in known:
        raise CatalogError(f"The table '{path}' has no version {version}")
    number = known[-1] if version is None else version
    listed = spark.read.text(f"{path}/{FOLDER}/v{number:012d}").collect()       # a row a data file, as in Spark's own file index
    return Snapshot(path, number, tuple(r["value"] for r in listed))


def publish(spark: SparkSession, base: Snapshot, files: Iterable[str]) -> Snapshot:
    """Make ``files`` the version after ``base``; if another writer has made
    that one meanwhile, nothing changes and an error says so."""
    fs, make = _fs(spark, base.path)
    done = Snapshot(base.path, base.version + 1, tuple(files))
    final = make(f"{base.path}/{FOLDER}/v{done.version:012d}")
    draft = make(f"{base.path}/{FOLDER}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    for name in done.files:
        out.write(bytearray(f"{name}\n".encode()))
    out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise CatalogError(f"Another writer committed version {done.version} of '{base.path}'; read it again and retry")
    return done


def read_files(spark: SparkSession, snap: Snapshot, names: Iterable[str] | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Rows of all files of a version, or of some of them."""
    names = list(snap.files if names is None else names)
    if not names:
        return spark.createDataFrame([], schema if schema is not None else T.StructType())
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*snap.full(names))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``: its latest version, or the plain folder."""
    if not is_versioned(spark, path):
        return spark.read.parquet(path)
    snap = snapshot(spark, path)
    return read_files(spark, snap)


def add_files(spark: SparkSession, path: str, rows: DataFrame) -> list[str]:
    """``rows`` as new data files of the folder, in no version yet."""
    path = path.rstrip("/")
    fs, make = _fs(spark, path)
    name = f"commit-{uuid.uuid4().hex[:12]}"
    try:
        rows.write.mode("errorifexists").parquet(f"{path}/{name}")
    except Exception:
        fs.delete(make(f"{path}/{name}"), True)
        raise
    return _data_files(fs, make, path, name)


def replace(spark: SparkSession, path: str, rows: DataFrame) -> Snapshot:
    """W-12 without a gap: ``rows`` become the table's next version."""
    base = snapshot(spark, path)
    return publish(spark, base, add_files(spark, path, rows))


def expire(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete the versions before the last ``keep`` ones, and the data files
    that only they name; returns how many files went.  Files that no version
    names (of a commit under way) stay."""
    if keep < 1:
        raise CatalogError("At least one version must be kept")
    last = snapshot(spark, path)
    fs, make = _fs(spark, last.path)
    known = sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(make(f"{last.path}/{FOLDER}"))
                   if s.getPath().getName().startswith("v")) if last.version else []
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return 0
    listed = {f for v in old for f in snapshot(spark, path, v).files}
    if old[0] == 1:     # version 0 was the plain folder
        listed |= set(_data_files(fs, make, last.path))
    gone = listed - {f for v in kept for f in snapshot(spark, path, v).files}
    for name in gone:
        fs.delete(make(f"{last.path}/{name}"), False)
    for v in old:
        fs.delete(make(f"{last.path}/{FOLDER}/v{v:012d}"), False)
    return len(gone)
