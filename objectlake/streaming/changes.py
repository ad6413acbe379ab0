"""Change-event streams (S-15, T-01..T-07, D-04).

A change message is JSON text:

    {"event": {"type": "created|updated|deleted|undeleted",
               "createdDate": "...", "replayId": 7},
     "sobject": {"Id": "...", "Name": "...", ...},
     "changedFields": ["Name", ...],          # optional
     "before": {"Name": "...", ...}}          # optional, prior image

Every function here but ``with_last_image`` is a stateless DataFrame transform, so the same code
runs on a batch DataFrame of messages (``spark.read.text``) and on a
streaming one (``spark.readStream.text``) — the stream query is checkpointed
by Structured Streaming and restarts from its source offsets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import CatalogError
from ..naming import normalize_name_col, quote
from ..operators.codec import decode_value, lower_keys

# The message envelope keys are event (type, createdDate,
# replayId), sobject (the changed record), changedFields and before.
# Event operation names and the notify-for-fields modes.
OPERATIONS = ("created", "updated", "deleted", "undeleted")
FIELD_MODES = ("All", "Referenced", "Select", "Where")

_ENVELOPE = T.StructType([
    T.StructField("event", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("createdDate", T.StringType()),
        T.StructField("replayId", T.LongType()),
    ])),
    T.StructField("sobject", T.MapType(T.StringType(), T.StringType())),
    T.StructField("changedFields", T.ArrayType(T.StringType())),
    T.StructField("before", T.MapType(T.StringType(), T.StringType())),
])


def _envelope(m: Column, last: Column | None = None) -> list[Column]:
    """The envelope columns of a parsed message; ``last`` (JSON) stands for a missing prior image."""
    before = lower_keys(m["before"])
    if last is not None:
        before = F.coalesce(before, F.from_json(last, "map<string,string>"))
    return [F.lower(m["event"]["type"]).alias("_op"),
            m["event"]["replayId"].alias("_replay_id"),
            lower_keys(m["sobject"]).alias("_after"),
            F.transform(m["changedFields"], lambda x: F.lower(normalize_name_col(x))).alias("_changed"),
            before.alias("_before"),
            m["sobject"].isNotNull().alias("_valid")]


def parse_messages(df: DataFrame, value_col: str = "value", last_col: str | None = None) -> DataFrame:
    """Message text → envelope columns plus ``_valid`` (JSON with an
    ``sobject`` object)."""
    env = F.from_json(F.col(value_col), _ENVELOPE)
    last = F.col(last_col) if last_col else F.lit(None).cast("string")
    return df.select(env.alias("__m"), F.col(value_col).alias("_raw"), last.alias("__last")) \
        .select(*_envelope(F.col("__m"), F.col("__last") if last_col else None), "_raw")


def with_last_image(messages: DataFrame, key_field: str, value_col: str = "value") -> DataFrame:
    """T-03 on messages that carry neither ``changedFields`` nor ``before``:
    the messages of a stream with ``last``, the record's image before each one (JSON of
    the fields that the message has; null for its first message), to be passed on as ``last_col``.

    The state of a key is its record's fields as the messages so far have left
    them, kept by the stream's state store; a deletion drops it.  Messages of one
    micro-batch are taken in the order of their replay ids.  Messages without
    the key (or that are no JSON) pass without state."""
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
    if not messages.isStreaming:
        raise CatalogError("Prior images are kept for streams only")
    env = F.from_json(F.col(value_col), _ENVELOPE)
    rows = messages.select(F.col(value_col).alias("value"), env.alias("m")).select(
        "value", F.col("m.event.replayId").alias("replay"), F.lower("m.event.type").alias("op"), lower_keys(F.col("m.sobject")).alias("after"))
    key = F.col("after")[F.lit(key_field.lower())]
    # those without a key are dealt out by their text
    rows = rows.select(F.coalesce(key, F.concat(F.lit("\x00"), F.xxhash64("value"))).alias("key"), key.isNotNull().alias("known"), "value",
                       F.coalesce("replay", F.lit(-1)).alias("replay"), F.coalesce("op", F.lit("")).alias("op"),
                       F.to_json("after", {"ignoreNullFields": "false"}).alias("after"))

    def remember(key, parts, state: GroupState):
        import json

        import pandas as pd
        rows = pd.concat(list(parts)).sort_values("replay", kind="stable")
        image, last = json.loads(state.get[0]) if state.exists else None, []
        for known, op, after in zip(rows["known"], rows["op"], rows["after"]):
            fields = json.loads(after) if known else {}
            # a field that the message leaves out stays as it is, so it stands in neither image
            last.append(json.dumps({k: v for k, v in image.items() if k in fields}) if image is not None else None)
            if known:
                image = None if op == "deleted" else {**(image or {}), **fields}
        if image is not None:
            state.update((json.dumps(image),))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({value_col: rows["value"], "last": pd.Series(last, index=rows.index, dtype=object)})
    return rows.groupBy("key").applyInPandasWithState(remember, f"`{value_col}` string, last string", "image string", "append", GroupStateTimeout.NoTimeout)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once (a lambda variable), however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def tag_changes(df: DataFrame, schema: T.StructType, value_col: str = "value", strict: bool = True,
                last_col: str | None = None) -> DataFrame:
    """One row a message, good or bad: the decoded fields, the envelope
    columns, ``_raw`` (the text), ``_good``, and ``_unread`` (names of fields whose text
    does not convert, or that are required and missing; with ``strict``).

    Each message is parsed once and each of its fields decoded once: the row
    leaves through a generator (inline of a one-element array), below which no later
    filter or column can be pushed.  Both outputs of a quarantine are filters on this."""
    mode = "try" if strict else False
    texts = [f.name.lower() for f in schema.fields]

    def row(m: Column) -> Column:
        return _bound(F.struct(*_envelope(m, F.col(last_col) if last_col else None)), lambda e: _bound(
            F.array(*[e["_after"][F.lit(t)] for t in texts]).cast("array<string>"), lambda after: _bound(
                F.struct(*[decode_value(after[i], f, mode).alias(f"f{i}") for i, f in enumerate(schema.fields)], F.lit(0).alias("none")),
                lambda d: _bound(F.when(e["_valid"], unread(after, d)).otherwise(F.array().cast("array<string>")),
                                 lambda names: F.struct(*[d[f"f{i}"].alias(f.name) for i, f in enumerate(schema.fields)],
                                                        *[e[c].alias(c) for c in ENVELOPE_COLUMNS], names.alias("_unread"),
                                                        (e["_valid"] & (F.size(names) == 0)).alias("_good"))))))

    def unread(after: Column, d: Column) -> Column:
        if not strict or not schema.fields:
            return F.array().cast("array<string>")
        out = []
        for i, f in enumerate(schema.fields):
            wrong = F.nullif(after[i], F.lit("")).isNotNull() & d[f"f{i}"].isNull()
            out.append(F.when((wrong | after[i].isNull()) if not f.nullable else wrong, F.lit(f.name)))
        return F.array_compact(F.array(*out))
    one = F.transform(F.array(F.from_json(F.col(value_col), _ENVELOPE)), row)
    return df.select(F.col(value_col).alias("_raw"), F.inline(one))


#: what an event carries beside the changed record's fields
ENVELOPE_COLUMNS = ("_op", "_replay_id", "_changed", "_before", "_after", "_valid")


def split_tagged(tagged: DataFrame, schema: T.StructType, keep_event: bool = True) -> tuple[DataFrame, DataFrame]:
    """Tagged messages → (rows, bad messages with the names of their bad fields)."""
    extra = [c for c in ENVELOPE_COLUMNS if c != "_valid"] if keep_event else []
    rows = tagged.where("_good").select(*[F.col(quote(f.name)) for f in schema.fields], *extra)
    return rows, tagged.where("NOT _good").select(F.col("_raw").alias("message"), F.col("_unread").alias("fields"))


def decode_changes(df: DataFrame, schema: T.StructType, value_col: str = "value",
                   on_error: str = "fail", keep_event: bool = True,
                   strict: bool = True, last_col: str | None = None) -> DataFrame | tuple[DataFrame, DataFrame]:
    """D-04/T-01/T-07: decode messages to ``schema``.

    Fields of ``sobject`` match schema fields ignoring case and name rules;
    unknown fields are ignored, missing ones are null; a nested object is only
    accepted by a string field (kept as JSON text), elsewhere it fails the
    cast.  A message that is not JSON, has no ``sobject``, or (strict) holds a
    value that its field cannot take or lacks a required one, fails the job
    (``on_error="fail"``) or goes to a second output (``"quarantine"``: returns
    ``(rows, bad_messages)``, the latter with the names of the bad fields), so
    that good and bad messages together are all of them.  ``last_col`` names a
    column with prior images (:func:`with_last_image`).
    """
    if on_error not in ("fail", "quarantine"):
        raise CatalogError(f"Unknown error policy '{on_error}'")
    if on_error == "quarantine":
        return split_tagged(tag_changes(df, schema, value_col, strict, last_col), schema, keep_event)
    extra = ["_op", "_replay_id", "_changed", "_before", "_after"] if keep_event else []
    p = parse_messages(df, value_col, last_col)
    checked = p.withColumn("_after", F.when(F.col("_valid"), F.col("_after")).otherwise(
        F.raise_error(F.concat(F.lit("Invalid change message: "), F.col("_raw")))
        .cast(T.MapType(T.StringType(), T.StringType()))))

    # The decoded row leaves through a generator (inline of a one-element
    # array): later filters on its columns cannot be pushed below it, so
    # each message is parsed once instead of once per filter reference.
    def build(after: Column) -> Column:
        return F.struct(*[decode_value(after[F.lit(f.name.lower())], f, strict).alias(f.name)
                          for f in schema.fields], *[after.alias(c) if c == "_after" else F.col(c) for c in extra])
    return checked.select(F.inline(F.transform(F.array(F.col("_after")), build)))


def notify(df: DataFrame, create: bool = True, update: bool = True, delete: bool = True,
           undelete: bool = True) -> DataFrame:
    """T-02: drop events of the operations that are switched off; events
    without an operation, or with another one, stay."""
    off = [o for o, on in zip(OPERATIONS, (create, update, delete, undelete)) if not on]
    return df.filter(~F.coalesce(F.col("_op").isin(off), F.lit(False))) if off else df


def changed_fields(df: DataFrame, fields: Iterable[str]) -> Column:
    """Names (lower case) among ``fields`` that the event changed: from
    ``changedFields`` when the message lists them, else by comparing the
    ``before`` image with the new one (null-safe)."""
    names = [f.lower() for f in fields]
    by_image = F.filter(F.array(*[F.lit(n) for n in names]),
                        lambda n: ~F.col("_before")[n].eqNullSafe(F.col("_after")[n]))
    listed = F.array_intersect(F.col("_changed"), F.array(*[F.lit(n) for n in names]))
    return F.when(F.col("_changed").isNotNull(), listed).when(F.col("_before").isNotNull(), by_image) \
        .otherwise(F.array(*[F.lit(n) for n in names]))


def notify_for_fields(df: DataFrame, mode: str = "Referenced", select_fields: Iterable[str] = (),
                      where_fields: Iterable[str] = (), cond: Column | None = None) -> DataFrame:
    """T-03: ``All`` — any change, the row must match ``cond``;
    ``Referenced`` (default) — a SELECT or WHERE field changed; ``Select`` —
    a SELECT field changed; ``Where`` — a WHERE field changed.  The last three
    also need ``cond``.  Field tests apply to updates; other events only need
    ``cond``."""
    m = {x.lower(): x for x in FIELD_MODES}.get(mode.lower())
    if m is None:
        raise CatalogError(f"Unknown notify-for-fields mode '{mode}'")
    match = cond if cond is not None else F.lit(True)
    if m == "All":
        return df.filter(match)
    watched = {"Referenced": list(select_fields) + list(where_fields),
               "Select": list(select_fields), "Where": list(where_fields)}[m]
    changed = F.size(changed_fields(df, watched)) > 0 if watched else F.lit(False)
    return df.filter(match & (~F.col("_op").eqNullSafe("updated") | changed))


def read_changes(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "text",
                 on_error: str = "fail", **options):
    """S-15: a streaming DataFrame of decoded change rows from message files
    (one JSON message per line) arriving under ``path``, or from a Kafka
    topic (``fmt="kafka"`` with the usual ``kafka.*``/``subscribe`` options;
    needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format(fmt).options(**options)
    stream = reader.load() if fmt == "kafka" else reader.load(path)
    if fmt == "kafka":
        # Kafka records carry the message as bytes in ``value``
        stream = stream.select(F.col("value").cast("string").alias("value"))
    return decode_changes(stream, schema, on_error=on_error)


def stream_query_fields(catalog, obj: str) -> list[str]:
    """T-06: with no query, a stream selects every field except long text."""
    from ..catalog import STREAM_SKIP_TYPES
    return [f for f in catalog.fields(obj) if catalog.field_type(obj, f).lower() not in STREAM_SKIP_TYPES]


def start_change_stream(spark: SparkSession, path: str, schema: T.StructType, out_path: str,
                        checkpoint: str, *, fmt: str = "text", query=None,
                        operations: dict | None = None, field_mode: str | None = None,
                        select_fields: Iterable[str] = (), where_fields: Iterable[str] = (),
                        cond: Column | None = None, quarantine_path: str | None = None,
                        available_now: bool = False, processing_time: str | None = None,
                        remember: str | None = None, **options):
    """S-15 end to end: messages under ``path`` → decoded rows → operation
    filter (T-02, ``operations`` like ``{"delete": False}``) → field-change
    filter (T-03) → the fields and filters of ``query`` (T-04, an
    ``ObjectQuery`` over the same schema) → Parquet at ``out_path``.

    Without ``quarantine_path`` a bad message fails the stream (T-07 "fail").
    With it, each micro-batch writes its good rows and its bad messages to
    ``<out>/epoch=<id>`` and ``<quarantine>/epoch=<id>`` with overwrite, so a
    retried micro-batch replaces its own output instead of duplicating it.
    ``remember`` names the key field by which prior images are kept for messages
    without one (:func:`with_last_image`).
    Returns the running ``StreamingQuery``; progress is kept in
    ``checkpoint``."""
    reader = spark.readStream.format(fmt).options(**options)
    raw = reader.load() if fmt == "kafka" else reader.load(path)
    if fmt == "kafka":
        raw = raw.select(F.col("value").cast("string").alias("value"))
    last_col = "last" if remember else None
    if remember:
        raw = with_last_image(raw, remember)

    def shape(rows: DataFrame) -> DataFrame:
        if operations:
            rows = notify(rows, **operations)
        if field_mode:
            rows = notify_for_fields(rows, field_mode, select_fields, where_fields, cond)
        elif cond is not None:
            rows = rows.filter(cond)
        return query.over(rows) if query is not None else rows.drop("_changed", "_before", "_after")

    if quarantine_path is None:
        out = shape(decode_changes(raw, schema, on_error="fail", last_col=last_col))
        writer = out.writeStream.format("parquet").option("path", out_path)
    else:
        def each_batch(batch: DataFrame, epoch: int) -> None:
            # kept for the two writes; blocks lost with an executor are made again
            tagged = tag_changes(batch, schema, last_col=last_col).persist()
            good, bad = split_tagged(tagged, schema)
            shape(good).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch}")
            bad.write.mode("overwrite").parquet(f"{quarantine_path.rstrip('/')}/epoch={epoch}")
            tagged.unpersist()
        writer = raw.writeStream.foreachBatch(each_batch)
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def stream_schema(catalog, obj: str) -> T.StructType:
    """T-06: the schema of a stream defined by an object name alone — every
    field of the object except long text, in object order."""
    st = catalog.schema(obj)
    keep = set(stream_query_fields(catalog, obj))
    return T.StructType([f for f in st.fields if f.name in keep])
