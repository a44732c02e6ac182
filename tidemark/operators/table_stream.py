"""Reading a table: columns, predicates, the replication key's bound, order, limit, maps and flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import INCREMENTAL, Settings
from tidemark.functions.identifiers import quoted
from tidemark.functions.values import iso_timestamp
from tidemark.plans.catalog import DELETED, LSN, StreamSpec


def where_all(df: DataFrame, clauses: Sequence[str]) -> DataFrame:
    """All predicates hold; each is a condition of its own, so an OR inside one binds nothing else."""
    return reduce(lambda d, c: d.filter(F.expr(c)), clauses, df)


def since(df: DataFrame, key: str, start: Any | None) -> DataFrame:
    """Rows from a start value on, itself included: at least once. Null keys have no place after it; without a start all rows count.

    A start that is text, as state files have it, is read as the key's type.
    """
    return df if start is None else df.filter(quoted(key) >= _as_key(df, key, start))


def _as_key(df: DataFrame, key: str, value: Any) -> Column:
    return F.lit(value).cast(df.schema[key].dataType) if isinstance(value, str) else F.lit(value)


def in_order(df: DataFrame, key: str, *more: str) -> DataFrame:
    return df.orderBy(quoted(key).asc_nulls_first(), *map(quoted, more))


def ranked(df: DataFrame, folder: str, key: str, *more: str) -> DataFrame:
    """All rows with ``pos``, their place in replication order from 1 on.

    The order's ranges are written to a folder once and counted, so a place is
    the rows of the ranges before plus the place within the range, and no task
    holds all rows.
    """
    in_order(df, key, *more).withColumn("_at", F.monotonically_increasing_id()).write.parquet(folder)
    rows = df.sparkSession.read.parquet(folder).withColumn("_range", F.shiftright("_at", 33))
    bases, base = [], 0
    for r in rows.groupBy("_range").count().orderBy("_range").collect():
        bases.append((r["_range"], base))
        base += r["count"]
    before = df.sparkSession.createDataFrame(bases, "_range long, _base long")
    place = F.col("_base") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(F.broadcast(before), "_range").select(*map(quoted, df.columns), place.alias("pos"))


def limited(df: DataFrame, most: int | None) -> DataFrame:
    """At most so many rows; 0 and None mean all."""
    return df.limit(most) if most else df


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text. A source with dates that Spark can't hold should give text itself."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    dates = {c: quoted(c).cast("string") for c, k in kinds.items() if isinstance(k, T.DateType)}
    times = {c: iso_timestamp(quoted(c)) for c, k in kinds.items() if isinstance(k, (T.TimestampType, T.TimestampNTZType))}
    return df.withColumns(dates | times) if dates or times else df


def read_stream(df: DataFrame, spec: StreamSpec, settings: Settings | None = None, start: Any | None = None, where: Sequence[str] | None = None) -> DataFrame:
    """A table stream: predicates, then the key's bound, the columns, the order, the limit.

    All of it is one plan, so predicates and columns reach the scan, and an
    ordered limit is a top-k without a full sort.  ``where`` replaces the
    settings' predicates (give none if the source has applied them already).
    """
    df = where_all(df, settings.where(spec.name) if where is None and settings else where or ())
    if spec.method == INCREMENTAL and spec.replication_key:
        df = since(df, spec.replication_key, start if start is not None else settings and settings.start_date)
        df = in_order(df.select(*map(quoted, spec.columns)), spec.replication_key, *spec.keys)
    else:
        df = df.select(*map(quoted, spec.columns))
    df = limited(df, settings.max_record_count if settings else None)
    return dates_as_text(df) if settings and settings.dates_as_string else df


def bootstrap(df: DataFrame, spec: StreamSpec, where: Sequence[str] = ()) -> DataFrame:
    """A snapshot in the shape of the change log: real columns, no deletion, no position. No limit."""
    nulls = {DELETED: F.lit(None).cast("string"), LSN: F.lit(None).cast("bigint")}
    return where_all(df, where).select(*map(quoted, spec.real_columns)).withColumns(nulls)


def new_bookmark(df: DataFrame, key: str, old: Any | None = None) -> DataFrame:
    """The greatest key seen, never less than the old one; null only if there is neither."""
    new = F.max(quoted(key))
    return df.agg((F.greatest(new, _as_key(df, key, old)) if old is not None else new).alias("bookmark"))


def mapped(df: DataFrame, rules: Mapping[str, str | None], keep: str | None = None, otherwise_drop: bool = False) -> DataFrame:
    """A stream map: name -> SQL expression (null drops the column), and a row predicate.

    Expressions see the columns as they were before the map.
    """
    if keep:
        df = df.filter(F.expr(keep))
    rest = [] if otherwise_drop else [quoted(c) for c in df.columns if c not in rules]
    return df.select(*rest, *(F.expr(e).alias(c) for c, e in rules.items() if e is not None))


def flattened(df: DataFrame, depth: int = 1, separator: str = "__") -> DataFrame:
    """Struct fields as columns of their own, down to a depth; the rest of a struct becomes JSON text."""

    def walk(column: Column, name: str, kind: T.DataType, left: int) -> list[Column]:
        if isinstance(kind, T.StructType) and left > 0:
            return [x for f in kind.fields for x in walk(column.getField(f.name), f"{name}{separator}{f.name}", f.dataType, left - 1)]
        return [(F.to_json(column) if isinstance(kind, (T.StructType, T.MapType, T.VariantType)) else column).alias(name)]

    found = [x for f in df.schema.fields for x in walk(quoted(f.name), f.name, f.dataType, depth)]
    flat = df.select(*found)
    if twice := sorted({c for c in flat.columns if flat.columns.count(c) > 1}):
        raise ValueError(f"flattening gives more than one column named {', '.join(twice)}")
    return flat
