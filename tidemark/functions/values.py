"""Log values: payload repair, array literals, typed values. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELL = "struct<name string, type string, value string>"
PAYLOAD = f"action string, schema string, table string, columns array<{_CELL}>, identity array<{_CELL}>, _corrupt string"


def repaired(payload: Column) -> Column:
    """Types of enums may come with doubled quotes, which is not JSON."""
    return F.regexp_replace(payload, '"type":""([^"]+)""', '"type":"$1"')


def parsed(payload: Column) -> Column:
    """The payload as a struct, or null; only what doesn't parse is repaired, once."""

    def read(text: Column) -> Column:
        found = F.from_json(text, PAYLOAD, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        return F.transform(F.array(found), lambda x: F.when(x["_corrupt"].isNull() & ltrim_brace(text), x))[0]

    return F.coalesce(read(payload), F.when(payload.contains('"type":""'), read(repaired(payload))))


def ltrim_brace(text: Column) -> Column:
    return F.substring(F.ltrim(text), 1, 1) == "{"


def _nested(depth: int) -> str:
    deeper = "" if depth == 1 else f"|{_nested(depth - 1)}"
    return r'\{(?:[^{}"]|"(?:[^"\\]|\\.)*"' + deeper + r")*\}"


#: Array literals inside others; the server's arrays have six dimensions at most.
_INNER = _nested(5)


def array_items(literal: Column) -> Column:
    """Items of an array literal such as ``{a,"b \\"q\\"",NULL}``, or of a JSON list; an item that is an array itself stays its literal."""
    raw = F.regexp_extract_all(F.regexp_replace(literal, r"^\s*\{|\}\s*$", ""), F.lit(rf'("(?:[^"\\]|\\.)*"|{_INNER}|[^,"{{}}]+)'), F.lit(1))
    quoted = lambda x: F.regexp_replace(F.substring(x, F.lit(2), F.length(x) - 2), r"\\(.)", "$1")
    items = F.transform(raw, lambda x: F.when(F.substring(x, 1, 1) == '"', quoted(x)).when(F.upper(F.trim(x)) == "NULL", None).otherwise(F.trim(x)))
    as_list = F.from_json(literal, "array<string>")
    return F.when(F.ltrim(literal).startswith("["), as_list).when(F.ltrim(literal).startswith("{"), items)


def is_numeric_name(kind: Column) -> Column:
    """Exact base types: ``interval`` is none, whatever it contains."""
    base = F.lower(F.trim(F.regexp_replace(kind, r"\(.*\)", "")))
    return base.isin("smallint", "integer", "int", "int2", "int4", "int8", "bigint", "numeric", "decimal", "real", "float", "float4", "float8", "double", "double precision")


def typed(value: Column, kind: Column, to: T.DataType) -> Column:
    """A log value as its column's type. What can't be cast is null (see ``is_lost``), and so is an empty text of a numeric type."""
    value = F.when(~(F.coalesce(is_numeric_name(kind), F.lit(False)) & (value == "")), value)
    if isinstance(to, T.ArrayType):
        item = to.elementType
        return F.transform(array_items(value), lambda x: x if isinstance(item, T.StringType) else x.try_cast(item))
    if isinstance(to, T.VariantType):
        return F.try_parse_json(value)
    if isinstance(to, T.MapType):
        return hstore(value)
    if isinstance(to, T.BooleanType):
        return F.when(F.lower(value).isin("t", "true", "1", "yes", "on"), True).when(F.lower(value).isin("f", "false", "0", "no", "off"), False)
    return value if isinstance(to, T.StringType) else value.try_cast(to)


def is_lost(value: Column, kind: Column, to: T.DataType) -> Column:
    """Whether a value that is there can't be had as its column's type, or an item of it: ``infinity``, a number of too many digits."""
    made = typed(value, kind, to)
    there = value.isNotNull() & ~(F.coalesce(is_numeric_name(kind), F.lit(False)) & (value == ""))
    lost = there & made.isNull()
    if isinstance(to, T.ArrayType) and not isinstance(to.elementType, T.StringType):
        gone = lambda a: F.size(F.filter(a, lambda x: x.isNull()))
        lost = lost | F.coalesce(there & (gone(made) != gone(array_items(value))), F.lit(False))
    return F.coalesce(lost, F.lit(False))


def hstore(text: Column) -> Column:
    """``"a"=>"b", "c"=>NULL`` as a map; of equal keys the last counts."""
    pairs = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]|\\.)*"=>(?:NULL|"(?:[^"\\]|\\.)*"))'), F.lit(1))
    plain = lambda x: F.regexp_replace(F.regexp_replace(x, '^"|"$', ""), r"\\(.)", "$1")
    key = lambda p: plain(F.regexp_extract(p, r'^("(?:[^"\\]|\\.)*")=>', 1))
    val = lambda p: F.when(~p.endswith("=>NULL"), plain(F.regexp_extract(p, r'=>("(?:[^"\\]|\\.)*")$', 1)))
    keys = F.transform(pairs, key)
    last = F.filter(F.transform(pairs, lambda p, i: F.struct(key(p).alias("k"), val(p).alias("v"), i.alias("i"))), lambda e: ~F.array_contains(F.slice(keys, e["i"] + 2, F.size(keys)), e["k"]))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))


def _in_utc(ts: Column) -> Column:
    """The wall clock in UTC, as text, of a moment, whatever the session's zone; a time without a zone is as it is.

    A moment becomes the wall clock of the session's zone by a cast, and that of UTC from there; text, as patterns would go by
    the session's zone again, in which some wall clocks don't exist.
    """
    wall = ts.cast("timestamp_ntz")
    return F.when(F.typeof(ts) == "timestamp", F.convert_timezone(F.current_timezone(), F.lit("UTC"), wall)).otherwise(wall).cast("string")


def _parts(ts: Column) -> tuple[Column, Column, Column]:
    text = _in_utc(ts)
    clock = F.substring_index(text, " ", -1)
    return F.substring_index(text, " ", 1), F.substring(clock, 1, 8), F.rpad(F.substring(clock, 10, 6), 6, "0")


def iso_timestamp(ts: Column) -> Column:
    day, second, fraction = _parts(ts)
    return F.concat(day, F.lit("T"), second, F.lit("."), fraction, F.lit("+00:00"))


def utc_second(ts: Column) -> Column:
    day, second, _ = _parts(ts)
    return F.concat(day, F.lit("T"), second, F.lit("Z"))
