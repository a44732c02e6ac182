"""Parts of a table that hold about as many rows each, as predicates on a key.

A database keeps statistics of a column: some common values with their shares,
bounds between which the rest lies in equal shares, and the share of nulls.  Cuts
through these give ranges of equal weight, each row in one.  A value that is
common enough for several parts by itself is dealt out by a second expression;
nulls have parts of their own.  Where there is no such key, ranges of a table's
pages do.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identifiers import quoted

#: Statistics of a column in the order of its values, asked of the database: common values with their shares, bounds with equal ones.
STATISTICS = """WITH s AS (SELECT * FROM pg_stats WHERE schemaname = '{schema}' AND tablename = '{table}' AND attname = '{column}'),
c AS (SELECT v, f FROM s, unnest(most_common_vals::text::{kind}[], most_common_freqs) AS u(v, f)),
b AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM s, unnest(histogram_bounds::text::{kind}[]) AS u(v)),
w AS (SELECT v, f AS weight, true AS common FROM c
  UNION ALL SELECT v, CASE WHEN i = 1 THEN 0 ELSE (1 - (SELECT null_frac FROM s) - coalesce((SELECT sum(f) FROM c), 0)) / greatest((SELECT count(*) FROM b) - 1, 1) END, false FROM b)
SELECT v::text AS value, weight, common, (SELECT null_frac FROM s) AS nulls FROM w ORDER BY w.v, common"""
#: Pages and rows of a table.
PAGES = "SELECT relpages, reltuples FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace WHERE nspname = '{schema}' AND relname = '{table}' AND relkind IN ('r', 'm')"
#: Deals rows of one value to parts, in the database's words: by where they lie.
SPREAD = "(ctid::text::point)[0]::bigint"


@dataclass(frozen=True)
class Point:
    """A value with the share of rows that are it (``common``), or that lie between the point before and it."""

    value: Any
    weight: float
    common: bool = False


@dataclass(frozen=True)
class Statistics:
    """Points in the order of their values, and the share of nulls."""

    points: tuple[Point, ...]
    nulls: float = 0.0


def literal(value: Any) -> str:
    """A value in a predicate; text that stands for a number or a time too, as the column's type reads it."""
    if isinstance(value, (int, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value.isoformat() if isinstance(value, date) else str(value)
    return "'" + text.replace("'", "''") + "'"


def _cuts(points: Sequence[Point], share: float) -> tuple[list[Any], list[tuple[Any, int]]]:
    """Bounds of ranges of about a share each, and values that are worth several parts, with how many. Such a value has bounds of its own."""
    bounds: list[Any] = []
    heavy: list[tuple[Any, int]] = []
    held = 0.0
    for i, p in enumerate(points):
        if p.common and p.weight > share:
            heavy.append((p.value, math.ceil(round(p.weight / share, 9))))
            continue
        held += p.weight
        # Behind a bound begins a new range, so one that is full ends at the next value.
        if held >= share and i + 1 < len(points) and p.value != points[0].value and not p.common:
            bounds.append(p.value)
            held = 0.0
        elif held >= share and p.common and i + 1 < len(points):
            bounds.append(points[i + 1].value)
            held = 0.0
    return list(dict.fromkeys(bounds)), heavy


def predicates(column: str, found: Statistics, parts: int, spread: str | None = SPREAD) -> list[str]:
    """Conditions of which each row fulfils one: ranges, values that are dealt out by ``spread`` (a whole-number expression), nulls."""
    if parts <= 1 or not found.points:
        return []
    share = 1 / parts
    bounds, heavy = _cuts(found.points, share)
    heavy = heavy if spread else []
    without = f" AND {column} NOT IN ({', '.join(literal(v) for v, _ in heavy)})" if heavy else ""
    low = [None, *bounds]
    high = [*bounds, None]
    out = []
    for a, b in zip(low, high):
        ends = [f"{column} >= {literal(a)}"] if a is not None else []
        ends += [f"{column} < {literal(b)}"] if b is not None else []
        out.append((" AND ".join(ends) or f"{column} IS NOT NULL") + without)
    for v, n in heavy:
        out += [f"{column} = {literal(v)} AND mod(abs({spread}), {n}) = {i}" for i in range(n)]
    n = max(1, math.ceil(round(found.nulls / share, 9))) if spread else 1
    out += [f"{column} IS NULL" + (f" AND mod(abs({spread}), {n}) = {i}" if n > 1 else "") for i in range(n)]
    return out


def page_predicates(pages: int, parts: int) -> list[str]:
    """Ranges of pages, which the database reads without the others; the last is open, as a table may grow meanwhile."""
    parts = max(1, min(parts, pages))
    if parts == 1:
        return []
    at = [pages * i // parts for i in range(1, parts)]
    tid = lambda p: f"'({p},0)'::tid"
    return [f"ctid < {tid(at[0])}", *(f"ctid >= {tid(a)} AND ctid < {tid(b)}" for a, b in zip(at, at[1:])), f"ctid >= {tid(at[-1])}"]


def statistics(df: DataFrame, column: str, buckets: int = 100, common: int = 100) -> Statistics:
    """The same of a table that Spark reads: its commonest values and the quantiles of the rest, by two aggregations over all rows."""
    key = quoted(column)
    counts = df.groupBy(key.alias("v")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return Statistics(())
    # A value is common if it is more than a bucket's worth; there are fewer such than buckets.
    top = counts.filter(F.col("v").isNotNull() & (F.col("n") > max(1, total / buckets))).orderBy(F.desc("n"), "v").limit(common).collect()
    nulls = counts.filter("v IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    rest = df.filter(key.isNotNull() & ~key.isin([r["v"] for r in top])) if top else df.filter(key.isNotNull())
    left = total - nulls - sum(r["n"] for r in top)
    points = [Point(r["v"], r["n"] / total, True) for r in top]
    if left:
        if dict(df.dtypes)[column] in ("string", "binary", "boolean"):
            bounds = [r["m"] for r in _ranges(rest, key, buckets).collect()]
        else:
            bounds = rest.agg(F.percentile_approx(key, [i / buckets for i in range(1, buckets + 1)], 10_000)).first()[0]
        bounds = [rest.agg(F.min(key)).first()[0], *bounds]
        points += [Point(v, 0.0 if i == 0 else left / total / (len(bounds) - 1)) for i, v in enumerate(bounds)]
    return Statistics(tuple(sorted(points, key=lambda p: (p.value, p.common))), nulls / total)


def _ranges(rest: DataFrame, key, buckets: int) -> DataFrame:
    """Greatest values of ranges that Spark makes of a column that has no quantiles."""
    return rest.select(key.alias("v")).repartitionByRange(buckets, "v").groupBy(F.spark_partition_id().alias("p")).agg(F.max("v").alias("m")).orderBy("p").select("m")
