"""Column types: from Postgres names and Spark types to JSON Schema, and back."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import types as T

#: Postgres type names and the Spark types that hold them.
POSTGRES: dict[str, T.DataType] = {
    "smallint": T.ShortType(), "int2": T.ShortType(), "integer": T.IntegerType(), "int": T.IntegerType(), "int4": T.IntegerType(), "bigint": T.LongType(), "int8": T.LongType(), "serial": T.IntegerType(), "bigserial": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(), "double precision": T.DoubleType(), "float8": T.DoubleType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(), "time": T.StringType(), "timestamp": T.TimestampNTZType(), "timestamp without time zone": T.TimestampNTZType(), "timestamp with time zone": T.TimestampType(), "timestamptz": T.TimestampType(),
    "json": T.VariantType(), "jsonb": T.VariantType(), "hstore": T.MapType(T.StringType(), T.StringType()),
}
#: An unconstrained numeric column; wide enough for most, and can be set.
NUMERIC = T.DecimalType(38, 18)
_ANY_JSON = ["string", "number", "integer", "array", "object", "boolean"]


def spark_type(name: str, numeric: T.DataType = NUMERIC) -> T.DataType:
    """The Spark type of a Postgres type name; what isn't known is text."""
    name = " ".join(name.strip().lower().split())
    if name.endswith("[]"):
        return T.ArrayType(spark_type(name[:-2], numeric))
    m = re.fullmatch(r"(?:numeric|decimal)(?:\((\d+)(?:,\s*(-?\d+))?\))?", name)
    if m:
        return T.DecimalType(int(m[1]), int(m[2] or 0)) if m[1] and int(m[1]) <= 38 and 0 <= int(m[2] or 0) <= int(m[1]) else numeric
    name = re.sub(r"\(\d+\)", "", name).replace("  ", " ").strip()
    return POSTGRES.get(name, T.StringType())


def json_schema(kind: T.DataType, *, dates_as_string: bool = False, json_as_object: bool = False) -> dict[str, Any]:
    """What a value of the type is in a record. Nullability is added by the stream."""
    again = {"dates_as_string": dates_as_string, "json_as_object": json_as_object}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType, **again)}
    if isinstance(kind, T.VariantType):
        return {"type": ["object", "null"] if json_as_object else list(_ANY_JSON), "additionalProperties": True}
    if isinstance(kind, (T.MapType, T.StructType)):
        return {"type": ["object", "null"], "additionalProperties": True}
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if dates_as_string:
            return {"type": ["string", "null"]}
        return {"type": "string", "format": "date" if isinstance(kind, T.DateType) else "date-time"}
    if isinstance(kind, T.BooleanType):
        return {"type": "boolean"}
    if isinstance(kind, T.IntegralType):
        return {"type": "integer"}
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return {"type": "number"}
    return {"type": "string"}


def as_list(kind: str | list[str]) -> list[str]:
    return [kind] if isinstance(kind, str) else list(kind)


def nullable(prop: dict[str, Any]) -> dict[str, Any]:
    """The property with null allowed, once; a type given as plain text becomes a list."""
    kinds = as_list(prop.get("type", _ANY_JSON))
    return prop | {"type": kinds if "null" in kinds else [*kinds, "null"]}


def from_json_schema(prop: dict[str, Any]) -> T.DataType:
    """The Spark type that holds a property's values and loses none.

    A schema doesn't tell a time with an offset from one without, nor a decimal
    from a float: such times stay text, and such numbers keep their own kind.
    """
    kinds = [k for k in as_list(prop.get("type", [])) if k != "null"]
    if len(kinds) > 1 and set(kinds) != {"number", "integer"}:
        return T.VariantType()
    kind = kinds[0] if kinds else "string"
    if kind == "array":
        return T.ArrayType(from_json_schema(prop.get("items", {"type": "string"})))
    if kind == "object":
        return T.VariantType()
    if kind == "string":
        return T.DateType() if prop.get("format") == "date" else T.StringType()
    return {"integer": T.LongType(), "number": T.VariantType(), "boolean": T.BooleanType()}[kind]
