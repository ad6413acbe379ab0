"""Row decode and encode as DataFrame transforms (D-01..D-07).

All conversions are built-in Spark expressions (casts, ``date_format``,
``transform``) applied column by column, so they run inside whole-stage
codegen on every partition; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogError
from ..naming import normalize_name, normalize_name_col, quote

# Field metadata key marking a long column as a time of day.
TIME_KEY = "logicalType"
TIME_MICROS = "time-micros"
TIME_MILLIS = "time-millis"
DATETIME_TEXT = "datetime"      # an ISO local date-time held as text

# The two file objects, their name field and data field.
FILE_OBJECTS = {
    "attachment": ("Attachment", "Name", "Body"),
    "contentversion": ("ContentVersion", "PathOnClient", "VersionData"),
}
DATA_FIELD_PREFIX = "#"


def time_field(name: str, unit: str = TIME_MICROS, nullable: bool = True) -> T.StructField:
    """A time-of-day field: long micros (or millis) of the day."""
    return T.StructField(name, T.LongType(), nullable, {TIME_KEY: unit})


def _time_unit(f: T.StructField) -> str | None:
    return (f.metadata or {}).get(TIME_KEY)


# --------------------------------------------------------------------- decode
def _parse_time_micros(v: Column) -> Column:
    # an ISO local time, whole and in range; an offset or Z may follow
    pat = r"^([01][0-9]|2[0-3]):([0-5][0-9])(?::([0-5][0-9])(?:\.([0-9]{1,9}))?)?(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?)?$"
    # one match; the parts then stand at fixed places
    second = F.when(v.substr(6, 1) == ":", v.substr(7, 2)).otherwise(F.lit("0")).cast("long")
    fraction = F.when(v.substr(9, 1) == ".", F.rpad(F.regexp_extract(v.substr(10, 6), "^[0-9]+", 0), 6, "0").cast("long")).otherwise(F.lit(0))
    micros = ((v.substr(1, 2).cast("long") * 60 + v.substr(4, 2).cast("long")) * 60 + second) * 1_000_000 + fraction
    return F.when(v.rlike(pat), micros)


def _strict(parsed: Column, text: Column, name: str, dt: T.DataType, strict: bool) -> Column:
    """Strict mode: a non-empty value that does not convert fails the job
    (independent of the session's ANSI setting); with ``strict="try"`` it
    is null, by the same rules of what converts."""
    if strict is not True:
        return parsed
    return F.when(text.isNotNull() & parsed.isNull(), F.raise_error(F.concat(
        F.lit(f"Field '{name}' cannot be read as {dt.simpleString()}: '"), text, F.lit("'"))).cast(dt)) \
        .otherwise(parsed)


def _fail(msg: str) -> Column:
    return F.raise_error(F.lit(msg))


def decode_value(c: Column, f: T.StructField, strict: bool = True, src_type: T.DataType | None = None) -> Column:
    """One string column → the field's type, with the reference's rules:
    empty string → null (Q1), null in a required field raises (Q2, strict),
    boolean is ``lower(x) = 'true'`` (Q3), DATE takes ``yyyy-MM-dd`` or an
    instant (Q4), timestamps keep millisecond precision, malformed numbers
    raise (strict) or become null."""
    dt = f.dataType
    name = f.name
    raw = c
    if src_type is not None and not isinstance(src_type, T.StringType) \
            and not isinstance(dt, (T.ArrayType, T.StructType)):
        # already typed input: convert, failing (strict) on values that do not fit
        out = _strict(c.try_cast(dt), c.cast("string"), name, dt, strict)
    elif isinstance(dt, T.ArrayType) and isinstance(dt.elementType, T.StructType):
        out = F.transform(raw, lambda x: _decode_map(x, dt.elementType, strict))
    elif isinstance(dt, T.StructType):
        out = _decode_map(raw, dt, strict)
    elif isinstance(dt, T.ArrayType):
        out = raw if src_type is None or isinstance(src_type, T.ArrayType) else \
            F.from_json(F.nullif(raw, F.lit("")), dt)
    else:
        v = F.nullif(raw, F.lit(""))
        unit = _time_unit(f)
        if isinstance(dt, T.StringType):
            out = v
        elif isinstance(dt, T.BooleanType):
            out = F.lower(v) == F.lit("true")
        elif unit is not None:
            micros = _parse_time_micros(v)
            if strict is True:
                micros = F.when(v.isNull() | micros.isNotNull(), micros).otherwise(
                    _fail(f"Field '{name}' has a malformed time value").cast("long"))
            out = micros if unit == TIME_MICROS else F.floor(micros / 1000).cast("long")
        elif isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            # strict: a sign and digits only, as an integer parser reads them
            parsed = F.when(v.rlike(r"^[+-]?[0-9]+$"), v.try_cast(dt)) if strict else v.try_cast(dt)
            out = _strict(parsed, v, name, dt, strict)
        elif isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
            out = _strict(v.try_cast(dt), v, name, dt, strict)
        elif isinstance(dt, T.DateType):
            as_day = F.when(v.contains("T"), F.to_date(v.try_cast("timestamp"))) \
                .otherwise(F.try_to_date(v, "yyyy-MM-dd"))
            out = _strict(as_day, v, name, dt, strict)
        elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
            # strict: an instant, so the text must end with Z or an offset
            instant = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9:.]+(Z|[+-][0-9]{2}(:?[0-9]{2})?)$"
            parsed = F.when(v.rlike(instant), v.try_cast("timestamp")) if strict else v.try_cast("timestamp")
            ts = _strict(parsed, v, name, T.TimestampType(), strict)
            out = F.date_trunc("millisecond", ts).cast(dt)
        else:
            raise CatalogError(f"Field '{name}' is of unsupported type '{dt.simpleString()}'")
    if strict is True and not f.nullable:
        out = F.when(raw.isNull(), _fail(f"Field '{name}' is required but has no value").cast(dt)) \
            .otherwise(out)
    return out


def lower_keys(m: Column) -> Column:
    """A string map with normalised lower-case keys; of keys that become the
    same one, the last value stays."""
    keys = F.transform(F.map_keys(m), lambda k: F.lower(normalize_name_col(k)))

    def build(ks: Column) -> Column:
        entries = F.arrays_zip(ks.alias("k"), F.map_values(m).alias("v"))
        last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(ks, i + 2, F.greatest(F.size(ks), F.lit(1))), e["k"]))
        return F.when(F.size(F.array_distinct(ks)) == F.size(ks), F.map_from_arrays(ks, F.map_values(m))) \
            .otherwise(F.map_from_entries(last))
    return F.when(m.isNotNull(), F.element_at(F.transform(F.array(keys), build), 1))


def _decode_map(m: Column, st: T.StructType, strict: bool) -> Column:
    """A string map (keys matched ignoring case and name rules) → struct.

    The re-keyed map is bound once as a lambda variable (a one-element array
    is transformed): referenced directly, it would be rebuilt for every field
    lookup, since common subexpressions are not shared inside lambdas."""
    lowered = lower_keys(m)

    def build(lm: Column) -> Column:
        return F.struct(*[decode_value(lm[F.lit(g.name.lower())], g, strict).alias(g.name) for g in st.fields])
    return F.when(m.isNotNull(), F.element_at(F.transform(F.array(lowered), build), 1))


def match_columns(df: DataFrame) -> dict[str, str]:
    """Input columns keyed by normalised, lower-cased name."""
    return {normalize_name(c).lower(): c for c in df.columns}


def decode(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """D-01/D-02: string columns → ``schema``.  Input names are normalised and
    matched ignoring case; unknown input columns are dropped; a schema field
    absent from the input is null."""
    cols = match_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        src = cols.get(normalize_name(f.name).lower())
        if src is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            out.append(decode_value(F.col(quote(src)), f, strict, types[src]).alias(f.name))
    return df.select(*out)


# --------------------------------------------------------------------- encode
def _local_time_text(ts: Column) -> Column:
    """Time part as ISO local time: HH:mm, then :ss and a 3/6-digit fraction
    only when not zero."""
    hm = F.date_format(ts, "HH:mm")
    ss = F.date_format(ts, "ss")
    frac = F.date_format(ts, "SSSSSS")
    return (F.when(frac != "000000",
                   F.when(frac.endswith("000"), F.concat(hm, F.lit(":"), ss, F.lit("."), frac.substr(1, 3)))
                   .otherwise(F.concat(hm, F.lit(":"), ss, F.lit("."), frac)))
            .when(ss != "00", F.concat(hm, F.lit(":"), ss))
            .otherwise(hm))


def encode_value(c: Column, f: T.StructField) -> Column:
    """D-03: one typed column → its text form for a CSV batch."""
    dt = f.dataType
    unit = _time_unit(f)
    if unit == TIME_MICROS:
        t = F.timestamp_micros(F.floor(c / 1000) * 1000)
        return F.when(c.isNotNull(), F.date_format(t, "HH:mm:ss.SSS'Z'"))
    if unit == TIME_MILLIS:
        t = F.timestamp_millis(c)
        return F.when(c.isNotNull(), _local_time_text(t))
    if (f.metadata or {}).get(TIME_KEY) == DATETIME_TEXT and isinstance(dt, T.StringType):
        # ISO local date-time kept as text: checked, then passed through
        ok = F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS]")).isNotNull()
        return F.when(c.isNull() | ok, c).otherwise(F.raise_error(F.concat(
            F.lit(f"Field '{f.name}' holds '"), c, F.lit("', not an ISO-8601 local date-time"))))
    if isinstance(dt, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dt, T.TimestampType):
        t = F.date_trunc("millisecond", c)
        return F.when(F.date_format(t, "SSS") == "000", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")) \
            .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    if isinstance(dt, T.TimestampNTZType):
        return F.when(c.isNotNull(), F.concat(F.date_format(c, "yyyy-MM-dd'T'"), _local_time_text(c)))
    if isinstance(dt, T.BinaryType):
        raise CatalogError(f"Field '{f.name}' is of unsupported type 'bytes'")
    if isinstance(dt, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def encode(df: DataFrame) -> DataFrame:
    """D-03 over every column; nulls stay null."""
    return df.select(*[encode_value(F.col(quote(f.name)), f).alias(f.name) for f in df.schema.fields])


# --------------------------------------------------------------- flatten D-05
def flatten(df: DataFrame, fields, children: dict | None = None) -> DataFrame:
    """D-05: nested object rows (parent objects as struct columns, children as
    arrays of structs) → flat columns.  ``fields`` are dotted paths or
    ``(path, alias)``; the alias wins, else the path with dots as ``_``.  A
    missing parent gives nulls.  ``children`` maps a relationship column to
    its own field list; each child element is flattened the same way."""
    out = []
    for item in fields:
        path, alias = (item if isinstance(item, tuple) else (item, None))
        out.append(_walk(F.col(quote(path.split(".")[0])), path.split(".")[1:]).alias(
            alias or normalize_name(path)))
    for rel, sub in (children or {}).items():
        out.append(F.coalesce(F.transform(F.col(quote(rel)), _element_flattener(sub)), F.array()).alias(rel))
    return df.select(*out)


def _element_flattener(sub):
    def elem(x):
        cols = []
        for item in sub:
            path, alias = (item if isinstance(item, tuple) else (item, None))
            parts = path.split(".")
            cols.append(_walk(x[parts[0]], parts[1:]).alias(alias or normalize_name(path)))
        return F.struct(*cols)
    return elem


def _walk(c: Column, rest: list[str]) -> Column:
    for p in rest:
        c = c[p]
    return c


# ------------------------------------------------------------ file payload D-06
def split_attachments(df: DataFrame, kind: str, order_by: str | None = None,
                      max_bytes: int = 10_000_000) -> tuple[DataFrame, DataFrame]:
    """D-06: for a file object, replace the base64 data field by
    ``#<ordinal>_<file name>`` and return the decoded files separately as
    (key, content, size).  Ordinals are 1-based in ``order_by`` order and
    computed without a single-partition window (see ``packing.global_index``).
    A file larger than ``max_bytes`` fails the job."""
    from .packing import global_index

    spec = FILE_OBJECTS.get(kind.lower())
    if spec is None:
        raise CatalogError(f"'{kind}' is not a file object")
    _, name_f, data_f = spec
    cols = match_columns(df)
    name_c = cols.get(name_f.lower())
    data_c = cols.get(data_f.lower())
    if name_c is None or data_c is None:
        raise CatalogError(f"A {spec[0]} row needs fields {name_f} and {data_f}")
    indexed = global_index(df, [order_by or name_c], "__ordinal")
    key = F.concat((F.col("__ordinal") + 1).cast("string"), F.lit("_"), F.col(quote(name_c)))
    content = F.unbase64(F.col(quote(data_c)))
    size = F.octet_length(content)
    checked = F.when(size > max_bytes, F.raise_error(F.lit(
        "A file is larger than the byte limit of a write batch")).cast("binary")).otherwise(content)
    rows = indexed.select(*[(F.concat(F.lit(DATA_FIELD_PREFIX), key) if c == data_c else F.col(quote(c))).alias(c)
                            for c in df.columns])
    files = indexed.select(key.alias("key"), checked.alias("content"), size.alias("size"))
    return rows, files


# ------------------------------------------------------------ conformance D-07
SUPPORTED_TYPES = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType,
                   T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.ArrayType,
                   T.StructType)


def conformance(df: DataFrame, schema: T.StructType) -> DataFrame:
    """D-07: how well text columns conform to ``schema``: per field the
    expected type, row count, nulls, blanks, values that fail the conversion
    and a verdict (``ok``, ``missing``, ``unsupported type``, ``type
    mismatch``, ``null in required field``).  One aggregate pass, then the
    per-field counts become rows."""
    cols = match_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, meta = [], []
    for i, f in enumerate(schema.fields):
        src = cols.get(normalize_name(f.name).lower())
        supported = isinstance(f.dataType, SUPPORTED_TYPES)
        meta.append((f, src, supported))
        if src is None or not supported:
            continue
        c = F.col(quote(src))
        txt = c.cast("string")
        parsed = decode_value(c, T.StructField(f.name, f.dataType, True, f.metadata), False, types[src])
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"),
                 F.count_if(txt == "").alias(f"b{i}"),
                 F.count_if(c.isNotNull() & (txt != "") & parsed.isNull()).alias(f"x{i}")]
    aggs.append(F.count(F.lit(1)).alias("rows"))
    counts = df.agg(*aggs)
    entries = []
    for i, (f, src, supported) in enumerate(meta):
        typ = F.lit(_time_unit(f) or f.dataType.simpleString())
        if src is None or not supported:
            verdict = "missing" if src is None else "unsupported type"
            entries.append(F.struct(F.lit(f.name).alias("field"), typ.alias("expected_type"),
                                    F.col("rows"), F.lit(None).cast("long").alias("nulls"),
                                    F.lit(None).cast("long").alias("blanks"),
                                    F.lit(None).cast("long").alias("bad_values"),
                                    F.lit(verdict).alias("verdict")))
            continue
        n, b, x = F.col(f"n{i}"), F.col(f"b{i}"), F.col(f"x{i}")
        verdict = (F.when(x > 0, F.lit("type mismatch"))
                   .when(F.lit(not f.nullable) & ((n + b) > 0), F.lit("null in required field"))
                   .otherwise(F.lit("ok")))
        entries.append(F.struct(F.lit(f.name).alias("field"), typ.alias("expected_type"), F.col("rows"),
                                n.alias("nulls"), b.alias("blanks"), x.alias("bad_values"),
                                verdict.alias("verdict")))
    return counts.select(F.inline(F.array(*entries)))
