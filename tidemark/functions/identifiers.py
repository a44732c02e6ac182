"""Names of tables: how they are shown, routed by, and written into the log's table filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import SLOT_NAME


def quoted(column: str) -> Column:
    """A column by its whole name, dots and backticks included."""
    return F.col("`" + column.replace("`", "``") + "`")


def shown_name(schema: Column, table: Column) -> Column:
    """``schema.table`` as it is: no quotes, no case folding."""
    return F.concat(schema, F.lit("."), table)


def route_key(schema: Column, table: Column) -> Column:
    """Tells ``("a.b", "c")`` from ``("a", "b.c")``, which are shown alike."""
    return F.concat(F.length(schema).cast("string"), F.lit(":"), schema, F.lit("."), table)


def route_name(schema: str, table: str) -> str:
    return f"{len(schema)}:{schema}.{table}"


def escaped(name: Column) -> Column:
    """A name in the log's table filter: backslash first, then comma and dot."""
    for ch in ("\\", ",", "."):
        name = F.replace(name, F.lit(ch), F.lit("\\" + ch))
    return name


def escape(name: str) -> str:
    return "".join("\\" + c if c in "\\,." else c for c in name)


def table_filter(tables: Iterable[tuple[str, str]]) -> str:
    return ",".join(f"{escape(s)}.{escape(t)}" for s, t in tables)


def is_slot_name(name: Column) -> Column:
    return name.rlike(f"^(?:{SLOT_NAME.pattern})$")
