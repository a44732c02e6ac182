"""From log payloads to typed rows, in one projection."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identifiers import route_key
from tidemark.functions.values import is_lost, parsed, typed, utc_second
from tidemark.plans.catalog import DELETED, LSN, StreamSpec

#: What becomes of a message. Only the first two give rows.
UPSERT, DELETE = "upsert", "delete"
MALFORMED, NON_DATA, UNROUTABLE, FILTERED, QUARANTINED, TRUNCATE, TRANSACTION, UNKNOWN = "malformed", "non_data", "unroutable", "filtered", "quarantined", "truncate", "transaction", "unknown"
EMITTED = (UPSERT, DELETE)


def decoded(log: DataFrame) -> DataFrame:
    """``lsn, payload`` with ``msg``, the parsed payload, null if it can't be read.

    The one-element explode keeps later filters above it: pushed below, each
    mention of ``msg`` would parse the payload again.
    """
    return log.select("*", F.explode(F.array(parsed(F.col("payload")))).alias("msg"))


def action_of(msg: Column) -> Column:
    a = msg["action"]
    return (
        F.when(a.isin("I", "U"), F.when(msg["columns"].isNull(), QUARANTINED).otherwise(UPSERT))
        .when(a == "D", F.when(msg["identity"].isNull(), QUARANTINED).otherwise(DELETE))
        .when(a == "T", TRUNCATE)
        .when(a.isin("B", "C"), TRANSACTION)
        .otherwise(UNKNOWN)
    )


def cells(msg: Column) -> Column:
    """What a row is made of: the new columns, or of a delete the identity."""
    return F.when(msg["action"] == "D", msg["identity"]).otherwise(msg["columns"])


def rows_of(messages: DataFrame, spec: StreamSpec, now: Column | None = None, carry_present: bool = False, carry_lost: bool = False, carry_order: bool = False) -> DataFrame:
    """Rows of a stream from its upserts and deletes (``lsn, msg, disposition``).

    Of equal column names the last counts; columns that a message lacks are
    null.  ``_present_cols`` tells those from columns that were set to null.
    ``now`` is the moment of deletion.  ``carry_lost`` adds ``payload`` and
    ``_lost``, the columns whose values their types can't hold.

    Messages nearly always have their columns in the table's order, so a cell is
    taken from its place and looked for only where another is there.
    """
    now = utc_second(F.current_timestamp()) if now is None else now
    kept = ["payload"] if carry_lost else []
    order = [c for c in ("commit", "seq") if c in messages.columns and carry_order]
    kept += order
    made = messages.select("lsn", "disposition", *kept, cells(F.col("msg")).alias("cells"))
    names = F.transform("cells", lambda x: x["name"])
    made = made.withColumn("_distinct", F.size(F.array_distinct(names)) == F.size("cells"))
    places = {c: i for i, c in enumerate(x for x in spec.properties if not x.startswith("_sdc_"))}
    at = lambda c: F.try_element_at("cells", F.lit(places[c] + 1))
    found = [F.when(F.col("_distinct") & (at(c)["name"] == c), at(c)).otherwise(F.try_element_at(_named(c), F.lit(-1))).alias(f"_cell{i}") for i, c in enumerate(spec.real_columns)]
    made = made.select("lsn", "disposition", *kept, "cells", *found)
    pairs = [(c, F.col(f"_cell{i}")) for i, c in enumerate(spec.real_columns)]
    out = [typed(cell["value"], cell["type"], spec.type_of(c)).alias(c) for c, cell in pairs]
    if carry_lost:
        lost = [F.when(is_lost(cell["value"], cell["type"], spec.type_of(c)), F.lit(c)) for c, cell in pairs if not isinstance(spec.type_of(c), T.StringType)]
        out += [F.col("payload"), F.array_compact(F.array(*lost)).alias("_lost") if lost else F.array().cast("array<string>").alias("_lost")]
    out += [F.when(F.col("disposition") == DELETE, now).alias(DELETED), F.col("lsn").cast("bigint").alias(LSN)]
    out += [F.col(c).alias(f"_{c}") for c in order]
    if carry_present:
        out.append(F.transform("cells", lambda x: x["name"]).alias("_present_cols"))
    return made.select(*out)


#: How values become JSON, and JSON values again: times have microseconds, those of a zone their offset.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _json(value: Column) -> Column:
    """A value alone as JSON text."""
    text = F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false", **JSON_TIMES})
    return F.substring(text, F.lit(len('{"v":') + 1), F.length(text) - len('{"v":}'))


def record_values(messages: DataFrame, specs: Sequence[StreamSpec], now: Column | None = None, shape: Callable[[Column, T.DataType], Column] | None = None) -> DataFrame:
    """``_stream, position, seq, lsn, payload, value, lost``: the rows of all streams in one pass, each as JSON text.

    A row has the columns that its message has: one that is missing is left out, one that was set to null is null.  Columns
    that the stream doesn't have, or doesn't want, are left out too; of equal names the last counts.  ``lost`` names columns
    whose values their types can't hold, which are null.  The plan has a branch for each type, however many the streams are:
    what is of which type is one literal.
    """
    now = utc_second(F.current_timestamp()) if now is None else now
    kinds: dict[str, T.DataType] = {}
    known: dict[str, dict[str, dict]] = {}
    for s in specs:
        known[s.name] = {}
        for c in s.real_columns:
            kinds.setdefault(s.type_of(c).json(), s.type_of(c))
            known[s.name][c] = {"t": list(kinds).index(s.type_of(c).json()), "k": json.dumps(c, ensure_ascii=False)}
    catalog = F.from_json(F.lit(json.dumps(known)), "map<string,map<string,struct<t:int,k:string>>>")
    cell = cells(F.col("msg"))
    rows = messages.filter(F.col("disposition").isin(*EMITTED)).select(
        F.col("stream").alias("_stream"), F.coalesce("commit", "lsn").alias("position"), F.coalesce("seq", F.lit(0).cast("bigint")).alias("seq"), "lsn", "payload", "disposition",
        F.explode(F.array(F.struct(F.try_element_at(catalog, "stream").alias("kinds"), cell.alias("cells")))).alias("_x"),
    )
    names = F.transform("_x.cells", lambda x: x["name"])
    last = F.filter("_x.cells", lambda x, i: ~F.array_contains(F.slice(names, i + 2, F.size("_x.cells")), x["name"]))
    once = F.when(F.size(F.array_distinct(names)) == F.size("_x.cells"), F.col("_x.cells")).otherwise(last)
    shape = shape or (lambda value, kind: value)

    def made(x: Column) -> Column:
        kind = F.try_element_at("_x.kinds", x["name"])
        value, lost = F.lit(None).cast("string"), F.lit(False)
        for i, t in enumerate(kinds.values()):
            value = F.when(kind["t"] == i, _json(shape(typed(x["value"], x["type"], t), t))).otherwise(value)
            if not isinstance(t, T.StringType):
                lost = F.when(kind["t"] == i, is_lost(x["value"], x["type"], t)).otherwise(lost)
        return F.struct(F.concat(kind["k"], F.lit(":"), value).alias("json"), F.when(lost, x["name"]).alias("lost"))

    rows = rows.select("*", F.explode(F.array(F.transform(F.filter(once, lambda x: F.try_element_at("_x.kinds", x["name"]).isNotNull()), made))).alias("_made"))
    deleted = F.concat(F.lit(f'"{DELETED}":'), _json(F.when(F.col("disposition") == DELETE, now)))
    at = F.concat(F.lit(f'"{LSN}":'), F.col("lsn").cast("string"))
    value = F.concat(F.lit("{"), F.array_join(F.concat(F.transform("_made", lambda x: x["json"]), F.array(deleted, at)), ","), F.lit("}"))
    return rows.select("_stream", "position", "seq", "lsn", "payload", value.alias("value"), F.array_compact(F.transform("_made", lambda x: x["lost"])).alias("lost"))


def columns_seen(messages: DataFrame) -> DataFrame:
    """``stream, name, type, position``: the columns that messages carry, with the type of the last and the place of the first."""
    carried = messages.filter(F.col("disposition").isin(*EMITTED)).select("stream", F.coalesce("commit", "lsn").alias("position"), F.transform(cells(F.col("msg")), lambda x: F.struct(x["name"].alias("name"), x["type"].alias("type"))).alias("cols"))
    lists = carried.groupBy("stream", "cols").agg(F.min("position").alias("first"), F.max("position").alias("last"))
    each = lists.select("stream", "first", "last", F.explode("cols").alias("c"))
    return each.groupBy("stream", F.col("c.name").alias("name")).agg(F.max_by("c.type", "last").alias("type"), F.min("first").alias("position"))


def _named(column: str) -> Column:
    return F.filter("cells", lambda x: x["name"] == F.lit(column))


def message_route(msg: Column) -> Column:
    return route_key(msg["schema"], msg["table"])
