"""Catalog of named objects kept as tables in a lake.

An object is a named DataFrame (usually a Parquet path plus a field mapping)
with an ordered field list, optional CRM field types, N:1 references, 1:N
child relationships, registered scopes and data-category groups.  Name lookup
ignores case (P-09).  Nothing here touches data: every method returns a lazy
DataFrame or plain metadata, so Catalyst sees the whole plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .naming import quote
from .session import tune

# Field types dropped from whole-object reads (compound fields),
# and from stream-derived queries (long text).
COMPOUND_TYPES = ("address", "location")
STREAM_SKIP_TYPES = ("textarea",)


class CatalogError(ValueError):
    """A name, path or rule check failed while building a plan."""

    def __init__(self, message: str, failures: list[str] | None = None):
        super().__init__(message)
        self.failures = failures or [message]


@dataclass(frozen=True)
class Reference:
    """N:1 edge: ``field`` on the owning object holds the Id of ``target``."""

    name: str
    field: str
    target: str


@dataclass(frozen=True)
class ChildRelationship:
    """1:N edge: rows of ``child`` whose ``field`` equals the parent Id."""

    name: str
    child: str
    field: str


@dataclass
class ObjectDef:
    name: str
    loader: Callable[[], DataFrame]
    id_field: str | None = "Id"
    label: str | None = None
    queryable: bool = True
    field_types: dict[str, str] = field(default_factory=dict)
    references: dict[str, Reference] = field(default_factory=dict)
    children: dict[str, ChildRelationship] = field(default_factory=dict)
    deleted_field: str | None = None
    modified_field: str | None = None
    external_ids: set[str] = field(default_factory=set)
    read_only: set[str] = field(default_factory=set)
    scopes: dict[str, object] = field(default_factory=dict)
    path: str | None = None
    _fields: list[str] | None = None

    @property
    def custom(self) -> bool:
        return self.name.endswith("__c")


@dataclass
class CategoryGroup:
    name: str
    edges: DataFrame          # (child string, parent string)
    assignment: str           # field path on the object holding the category
    objects: tuple[str, ...]
    paths: DataFrame | None = None      # (node, path to its root); None: the graph is no tree


def _spark_type_name(dt: T.DataType) -> str:
    """CRM field type implied by a Spark type (inverse of V-01)."""
    if isinstance(dt, T.BooleanType):
        return "boolean"
    if isinstance(dt, (T.IntegerType, T.ShortType, T.ByteType)):
        return "int"
    if isinstance(dt, T.LongType):
        return "long"
    if isinstance(dt, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "double"
    if isinstance(dt, T.DateType):
        return "date"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dt, T.ArrayType):
        return "complexvalue"
    return "string"


class Catalog:
    """Registry of objects over one Spark session."""

    def __init__(self, spark: SparkSession):
        self.spark = tune(spark)
        self._objects: dict[str, ObjectDef] = {}
        self._categories: dict[str, CategoryGroup] = {}
        self._functions: dict[str, Callable[[Column], Column]] = {}

    # ------------------------------------------------------------ register
    def register(self, name: str, source: DataFrame | str | Callable[[], DataFrame],
                 fields: Mapping[str, str | Column] | None = None, *,
                 id_field: str | None = "Id", label: str | None = None,
                 queryable: bool = True, field_types: Mapping[str, str] | None = None,
                 deleted_field: str | None = None, modified_field: str | None = None,
                 external_ids: Iterable[str] = (), read_only: Iterable[str] = ()) -> ObjectDef:
        """Register an object.

        ``source`` is a Parquet path, a table name of the session catalog
        (``db.table``), a DataFrame, or a zero-argument callable returning one.  ``fields`` maps object field names (in object order) to
        source columns or Column expressions; omitted, the source columns are
        the fields.
        """
        path = source if isinstance(source, str) and not _is_table_name(source) else None

        cache: dict[str, DataFrame] = {}

        def load() -> DataFrame:
            # one DataFrame per object: the file listing and footer reads of a
            # large table happen once, not once per join that uses the object
            if "df" not in cache:
                cache["df"] = build()
            return cache["df"]

        def build() -> DataFrame:
            if isinstance(source, str) and _is_table_name(source):
                df = self.spark.table(source)
            elif isinstance(source, str):
                from .sinks.versions import read_table
                df = read_table(self.spark, source)
            elif isinstance(source, DataFrame):
                df = source
            else:
                df = source()
            if fields:
                cols = [(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items()]
                df = df.select(*cols)
            return df

        obj = ObjectDef(name=name, loader=load, id_field=id_field, label=label or name,
                        queryable=queryable, field_types={k.lower(): v for k, v in (field_types or {}).items()},
                        deleted_field=deleted_field, modified_field=modified_field,
                        external_ids=set(external_ids), read_only=set(read_only), path=path)
        if fields:
            obj._fields = list(fields.keys())
        obj._cache = cache
        obj._mapped = bool(fields)
        self._objects[name.lower()] = obj
        return obj

    def discover(self, root: str, suffix: str = ".parquet") -> list[str]:
        """Register every Parquet folder or file directly under ``root`` as an
        object named after it (``orders.parquet`` → ``orders``); the fields are
        the columns.  Only file-system metadata is read.  Returns the names."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        base = jvm.org.apache.hadoop.fs.Path(root)
        names = []
        for st in base.getFileSystem(conf).listStatus(base):
            leaf = st.getPath().getName()
            if leaf.startswith((".", "_")):
                continue
            if not (st.isDirectory() or leaf.endswith(suffix)):
                continue
            name = leaf[: -len(suffix)] if leaf.endswith(suffix) else leaf
            self.register(name, st.getPath().toString(), id_field=None)
            names.append(name)
        return sorted(names)

    def refresh(self, name: str) -> None:
        """Forget the object's DataFrame (file listing) after its table changed."""
        getattr(self.get(name), "_cache", {}).clear()

    def commit(self, name: str, table: DataFrame, partition_by=None) -> str:
        """W-12 for a Parquet-backed object: stage ``table`` next to the
        object's folder, swap it in, and read the new files from then on.  A
        folder with versions gets a further one, without a gap for readers."""
        from .sinks import versions
        from .sinks.write import commit as commit_table
        obj = self._own_folder(name)
        if versions.is_versioned(self.spark, obj.path):
            if partition_by:
                raise CatalogError(f"Object '{obj.name}' has versions, which can't be partitioned by folders")
            versions.replace(self.spark, obj.path, table)
        else:
            commit_table(table, obj.path, partition_by=partition_by)
        self.refresh(name)
        return obj.path

    def merge(self, name: str, rows: DataFrame, operation: str, key: str | None = None, on_error: str = "fail"):
        """W-02/W-03 commit of an update or upsert that rewrites only the files
        with a key of ``rows`` (see :mod:`.sinks.merge`); the object reads the new
        version from then on.  Returns the ``MergeResult``."""
        from .sinks.merge import merge as merge_rows
        from .sinks.write import validate_write
        obj = self._own_folder(name)
        failures = validate_write(self.table(name).schema, rows.schema, operation, key, obj.id_field or "Id",
                                  obj.external_ids, obj.read_only)
        if failures:
            raise CatalogError("; ".join(failures), failures)
        done = merge_rows(self.spark, obj.path, rows, operation, key or obj.id_field or "Id", on_error)
        self.refresh(name)
        return done

    def _own_folder(self, name: str) -> ObjectDef:
        obj = self.get(name)
        if not obj.path or obj._mapped:
            raise CatalogError(f"Object '{obj.name}' is not stored as its own Parquet folder "
                               "(registered with a path and no field mapping)")
        return obj

    def append(self, name: str, rows: DataFrame, partition_by=None) -> str:
        """W-01 commit of an insert: ``rows`` become further files of a
        Parquet-backed object, no old file is rewritten.  Columns are matched by
        name without regard to case; absent ones are null."""
        from .sinks import versions
        from .sinks.write import append as append_rows
        obj = self._own_folder(name)
        have = {c.lower(): c for c in rows.columns}
        fields = self.table(name).schema.fields
        unknown = set(have) - {f.name.lower() for f in fields}
        if unknown:
            raise CatalogError(f"Fields {sorted(unknown)} do not exist in object '{obj.name}'")
        shaped = rows.select(*[(F.col(quote(have[f.name.lower()])) if f.name.lower() in have else F.lit(None))
                               .cast(f.dataType).alias(f.name) for f in fields])
        if versions.is_versioned(self.spark, obj.path):
            base = versions.snapshot(self.spark, obj.path)
            versions.publish(self.spark, base, [*base.files, *versions.add_files(self.spark, obj.path, shaped)])
        else:
            append_rows(shaped, obj.path, partition_by=partition_by)
        self.refresh(name)
        return obj.path

    def add_reference(self, obj: str, name: str, field_name: str, target: str,
                      child_name: str | None = None) -> None:
        """``obj.field_name`` points at ``target.Id`` through relationship ``name``;
        ``child_name`` also registers the reverse 1:N relationship on ``target``."""
        o = self.get(obj)
        o.references[name.lower()] = Reference(name, self.field_name(obj, field_name), self.get(target).name)
        if child_name:
            t = self.get(target)
            t.children[child_name.lower()] = ChildRelationship(child_name, o.name, self.field_name(obj, field_name))

    def register_scope(self, obj: str, name: str, predicate) -> None:
        """F-17: a named row scope, applied by ``ObjectQuery.scope(name)``."""
        self.get(obj).scopes[name.lower()] = predicate

    def register_category_group(self, name: str, edges: DataFrame, assignment: str,
                                objects: Iterable[str]) -> None:
        """F-18: a data-category tree given as (child, parent) rows; rows of the
        listed objects carry their category in the field path ``assignment``.
        The tree is labelled here (:func:`.operators.category.tree_paths`), so
        queries over it are lazy; register again when it changes."""
        from .operators.category import tree_paths
        tree = edges.select(F.col(edges.columns[0]).cast("string").alias("child"),
                            F.col(edges.columns[1]).cast("string").alias("parent"))
        self._categories[name.lower()] = CategoryGroup(name, tree, assignment, tuple(self.get(o).name for o in objects), tree_paths(tree))

    def register_function(self, name: str, fn: Callable[[Column], Column]) -> None:
        """C-15: map a function name to a one-argument Column function."""
        self._functions[name.lower()] = fn

    # -------------------------------------------------------------- lookup
    def get(self, name: str) -> ObjectDef:
        obj = self._objects.get(name.lower())
        if obj is None:
            raise CatalogError(f"Unknown object '{name}'" + _hint(name, [o.name for o in self._objects.values()]))
        return obj

    def has(self, name: str) -> bool:
        return name.lower() in self._objects

    def names(self, queryable_only: bool = False) -> list[str]:
        return [o.name for o in self._objects.values() if o.queryable or not queryable_only]

    def category_group(self, name: str) -> CategoryGroup:
        g = self._categories.get(name.lower())
        if g is None:
            raise CatalogError(f"Unknown data category group '{name}'")
        return g

    def function(self, name: str) -> Callable[[Column], Column] | None:
        return self._functions.get(name.lower())

    def schema(self, name: str) -> T.StructType:
        """S-14: the object's schema (analysis only, no job runs)."""
        return self.get(name).loader().schema

    def describe(self, name: str) -> dict:
        """S-14: the object's fields (name, Spark type, field type, nullable),
        references and child relationships — metadata only, nothing runs."""
        obj = self.get(name)
        st = self.schema(name)
        return {
            "name": obj.name, "label": obj.label, "queryable": obj.queryable, "custom": obj.custom,
            "id_field": obj.id_field,
            "fields": [{"name": f.name, "type": st[f.name].dataType.simpleString(),
                        "field_type": self.field_type(name, f.name), "nullable": st[f.name].nullable}
                       for f in st.fields if f.name in self.fields(name)],
            "references": [{"name": r.name, "field": r.field, "target": r.target}
                           for r in obj.references.values()],
            "children": [{"name": c.name, "child": c.child, "field": c.field} for c in obj.children.values()],
        }

    def fields(self, name: str) -> list[str]:
        obj = self.get(name)
        if obj._fields is None:
            obj._fields = list(self.schema(name).fieldNames())
        return list(obj._fields)

    def field_name(self, obj: str, name: str) -> str:
        """Resolve a field name ignoring case; raises naming the field (V-05)."""
        for f in self.fields(obj):
            if f.lower() == name.lower():
                return f
        raise CatalogError(f"Field '{name}' does not exist in object '{self.get(obj).name}'"
                           + _hint(name, self.fields(obj)))

    def field_type(self, obj: str, name: str) -> str:
        o = self.get(obj)
        real = self.field_name(obj, name)
        if real.lower() in o.field_types:
            return o.field_types[real.lower()]
        return _spark_type_name(self.schema(obj)[real].dataType)

    def reference(self, obj: str, name: str) -> Reference:
        ref = self.get(obj).references.get(name.lower())
        if ref is None:
            raise CatalogError(f"Reference '{name}' does not exist in object '{self.get(obj).name}'"
                               + _hint(name, [r.name for r in self.get(obj).references.values()]))
        return ref

    def child(self, obj: str, name: str) -> ChildRelationship:
        rel = self.get(obj).children.get(name.lower())
        if rel is None:
            raise CatalogError(
                f"Child relationship '{name}' does not exist in object '{self.get(obj).name}'")
        return rel

    def materialize(self, name: str, table: str, bucket_by: str | None = None, buckets: int = 0,
                    partition_by: str | None = None) -> ObjectDef:
        """Write the object as a table in the session catalog, bucketed on
        ``bucket_by`` (default: the Id) and optionally partitioned, with
        statistics; the object is then read from that table.  Joins on the
        bucket key between tables with equal bucket counts read without a
        shuffle, filters on ``partition_by`` prune whole folders, and the
        statistics let the planner size broadcasts."""
        obj = self.get(name)
        key = bucket_by or obj.id_field
        df = self.table(name)
        w = df.write.mode("overwrite").format("parquet")
        if partition_by:
            w = w.partitionBy(partition_by)
        if key and buckets:
            w = w.bucketBy(int(buckets), key).sortBy(key)
        w.saveAsTable(table)
        self.spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        fields = {f: f for f in self.fields(name)}
        new = self.register(obj.name, lambda: self.spark.table(table).select(*[F.col(f) for f in fields]),
                            None, id_field=obj.id_field, label=obj.label, queryable=obj.queryable,
                            field_types=obj.field_types, deleted_field=obj.deleted_field,
                            modified_field=obj.modified_field, external_ids=obj.external_ids,
                            read_only=obj.read_only)
        new.references, new.children, new.scopes = obj.references, obj.children, obj.scopes
        new._fields = list(fields)
        return new

    # --------------------------------------------------------------- scans
    def table(self, name: str, include_deleted: bool = True) -> DataFrame:
        """All fields of the object as a lazy DataFrame."""
        obj = self.get(name)
        df = obj.loader()
        if not include_deleted and obj.deleted_field:
            # "null or false", written so Parquet can use it as a row-group filter
            d = F.col(obj.deleted_field)
            df = df.filter(d.isNull() | ~d)
        return df

    def object(self, name: str, *, since=None, until=None, as_of=None, duration=None,
               offset=None, schema: T.StructType | None = None,
               skip_types: Iterable[str] = COMPOUND_TYPES,
               include_deleted: bool = False, check_schema: bool = True) -> DataFrame:
        """S-01 object scan: every field except ``skip_types`` in object order,
        restricted to the fields of ``schema`` when given (P-07), with the
        modified-time interval (F-09) or range (F-10) filter.

        A provided schema wins after the compatibility check (V-03: each of
        its fields exists with the same type; it may widen nullability), and
        the columns take its names."""
        from .functions.timefilter import modified_filter

        obj = self.get(name)
        skip = {t.lower() for t in skip_types}
        cols = [f for f in self.fields(name) if self.field_type(name, f).lower() not in skip]
        if schema is not None:
            wanted = {f.name.lower() for f in schema.fields}
            cols = [c for c in cols if c.lower() in wanted]
            if not cols:
                raise CatalogError(f"None of the schema fields exist in object '{obj.name}'")
        df = self.table(name, include_deleted=include_deleted)
        cond = modified_filter(obj, since=since, until=until, as_of=as_of,
                               duration=duration, offset=offset)
        if cond is not None:
            df = df.filter(cond)
        out = df.select(*[F.col(c) for c in cols])
        if schema is not None:
            if check_schema:
                from .schema import compatibility
                failures = compatibility(out.schema, schema, check_nullability=False)
                if failures:
                    raise CatalogError("; ".join(failures), failures)
            names = {f.name.lower(): f.name for f in schema.fields}
            out = out.toDF(*[names[c.lower()] for c in out.columns])
        return out

    def sample(self, name: str, n: int) -> DataFrame:
        """S-12: first ``n`` rows of all non-compound fields (a sampling operator)."""
        return self.object(name, include_deleted=True).limit(int(n))

    def objects(self, allow: str | Iterable[str] | None = None,
                deny: str | Iterable[str] | None = None,
                name_field: str = "tablename", chunk_size: int | None = None,
                **scan_args) -> MultiObject:
        """S-03/S-04/S-05: one scan per selected object, tagged with its name.
        ``chunk_size`` also splits each object into key-range chunks (S-08)
        on its Id; objects that cannot be chunked (S-09) are an error."""
        from .operators.chunking import CHUNKABLE_OBJECTS, read_chunked
        from .sources.multi import select_objects

        chosen = select_objects(self, allow, deny)
        frames = {}
        for n in chosen:
            df = self.object(n, **scan_args)
            if chunk_size:
                o = self.get(n)
                if not (o.custom or n in CHUNKABLE_OBJECTS) or not o.id_field:
                    raise CatalogError(f"Object '{n}' does not support chunking")
                df = read_chunked(df, o.id_field, chunk_size)
            frames[n] = df.withColumn(name_field, F.lit(n))
        return MultiObject(frames, name_field)

    def summary(self, queryable_only: bool = False) -> DataFrame:
        """S-13: one row per object: name, label, queryable, rows, newest change."""
        parts = []
        for n in self.names(queryable_only):
            obj = self.get(n)
            df = self.table(n)
            newest = (F.max(F.col(obj.modified_field)).cast("timestamp_ntz")
                      if obj.modified_field else F.lit(None).cast("timestamp_ntz"))
            parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), newest.alias("last_modified"))
                         .select(F.lit(obj.name).alias("name"), F.lit(obj.label).alias("label"),
                                 F.lit(obj.queryable).alias("queryable"), "row_count", "last_modified"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _is_table_name(source: str) -> bool:
    """``db.table`` or ``table`` (no path separator, scheme or file suffix)."""
    return "/" not in source and ":" not in source and not source.endswith(".parquet")


def _hint(name: str, options: list[str]) -> str:
    import difflib
    close = difflib.get_close_matches(name.lower(), [o.lower() for o in options], n=1, cutoff=0.6)
    if not close:
        return ""
    match = [o for o in options if o.lower() == close[0]][0]
    return f" (did you mean '{match}'?)"


class MultiObject(dict):
    """Result of :meth:`Catalog.objects`: name → DataFrame, plus the union (U-01)."""

    def __init__(self, frames: dict[str, DataFrame], name_field: str):
        super().__init__(frames)
        self.name_field = name_field

    def union(self) -> DataFrame:
        frames = list(self.values())
        out = frames[0]
        for df in frames[1:]:
            out = out.unionByName(df, allowMissingColumns=True)
        return out

    def schemas(self) -> dict[str, T.StructType]:
        """S-06: per-object schema published for downstream sinks, keyed
        ``multisink.<object>``; the name field is a row-side column only."""
        return {f"multisink.{n}": T.StructType([f for f in df.schema.fields if f.name != self.name_field])
                for n, df in self.items()}
