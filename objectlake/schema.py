"""Type mapping and schema checks (V-01..V-03, A-16 helpers)."""

from __future__ import annotations

from pyspark.sql import types as T

from .operators.codec import TIME_MICROS, time_field

# Source field type → Spark type; any other type is text.
FIELD_TYPE_MAP = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "currency": T.DoubleType(),
    "percent": T.DoubleType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "string": T.StringType(),
    "complexvalue": T.ArrayType(T.StringType()),
}


def spark_type(field_type: str) -> T.DataType:
    """V-01: the Spark type of a source field type (``time`` is long micros)."""
    ft = field_type.lower().lstrip("_")
    if ft == "time":
        return time_field("t", TIME_MICROS).dataType
    return FIELD_TYPE_MAP.get(ft, T.StringType())


def schema_for(fields: list[tuple[str, str, bool]]) -> T.StructType:
    """(name, field type, nullable) → StructType with time metadata."""
    out = []
    for name, ft, nullable in fields:
        if ft.lower().lstrip("_") == "time":
            out.append(time_field(name, TIME_MICROS, nullable))
        else:
            out.append(T.StructField(name, spark_type(ft), nullable))
    return T.StructType(out)


SUPPORTED = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType,
             T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.ArrayType, T.StructType)


def unsupported_fields(schema: T.StructType) -> list[str]:
    """V-02: one failure per field of an unsupported type (bytes, map, ...)."""
    return [f"Field '{f.name}' is of unsupported type '{f.dataType.simpleString()}'"
            for f in schema.fields if not isinstance(f.dataType, SUPPORTED)]


def compatibility(actual: T.StructType, provided: T.StructType, check_nullability: bool = True) -> list[str]:
    """V-03: every provided field exists (any case) with the same type; a
    non-nullable field may not be declared over a nullable one unless the
    check is off; extra actual fields are fine."""
    act = {f.name.lower(): f for f in actual.fields}
    out = []
    for f in provided.fields:
        a = act.get(f.name.lower())
        if a is None:
            out.append(f"Field '{f.name}' does not exist")
            continue
        if a.dataType != f.dataType:
            out.append(f"Field '{f.name}' is {a.dataType.simpleString()}, declared {f.dataType.simpleString()}")
        if check_nullability and a.nullable and not f.nullable:
            out.append(f"Field '{f.name}' is nullable but declared non-nullable")
    return out
