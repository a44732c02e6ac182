"""Tables to read: a folder of Parquet files, or a database by JDBC.

The JDBC paths are untested against a server: none can be reached from here.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Settings
from tidemark.functions.types import json_schema, nullable, spark_type
from tidemark.plans.catalog import Catalog, StreamSpec, of_frame, schema_names
from tidemark.sources import splits
from tidemark.sources.connection import Connection


class Tables(Protocol):
    def discover(self, settings: Settings) -> Catalog: ...
    def splits(self, stream: StreamSpec, parts: int) -> list[str]: ...
    def scan(self, stream: StreamSpec, where: Sequence[str] = ()) -> DataFrame: ...


@dataclass
class ParquetTables:
    """``<folder>/<table>.parquet`` for each table; all are in one schema."""

    spark: SparkSession
    folder: str
    tables: dict[str, tuple[str, ...]]
    schema: str = "public"

    def discover(self, settings: Settings) -> Catalog:
        if self.schema not in schema_names([self.schema], settings):
            return Catalog([])
        return Catalog([of_frame(self.schema, t, self._read(t), settings, keys) for t, keys in self.tables.items()])

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    def splits(self, stream: StreamSpec, parts: int) -> list[str]:
        """Predicates of parts with about as many rows each, by the first key column."""
        if not stream.keys:
            return []
        found = splits.statistics(self._read(stream.table), stream.keys[0])
        return splits.predicates("`" + stream.keys[0].replace("`", "``") + "`", found, parts, f"xxhash64({', '.join(stream.keys)})" if len(stream.keys) > 1 else None)

    def scan(self, stream: StreamSpec, where: Sequence[str] = ()) -> DataFrame:
        """The table with its predicates; each is one condition, whatever it is made of."""
        df = self._read(stream.table)
        for clause in where:
            df = df.filter(F.expr(clause))
        return df


#: Columns and primary keys of all tables and views of some schemas.
_COLUMNS = """SELECT c.table_schema, c.table_name, c.column_name, c.ordinal_position, c.is_nullable, format_type(a.atttypid, a.atttypmod) AS kind,
  EXISTS (SELECT 1 FROM pg_index i WHERE i.indrelid = a.attrelid AND i.indisprimary AND a.attnum = ANY (i.indkey)) AS is_key
FROM information_schema.columns c JOIN pg_namespace n ON n.nspname = c.table_schema
JOIN pg_class r ON r.relname = c.table_name AND r.relnamespace = n.oid JOIN pg_attribute a ON a.attrelid = r.oid AND a.attname = c.column_name
WHERE c.table_schema NOT IN ('pg_catalog', 'information_schema')"""


@dataclass
class JdbcTables:
    """Tables of a database, read in ``parts`` by as many tasks: by ranges of the replication key or of the first key column,
    as the database's statistics cut it, or without those by ranges of pages; views without either are one part.
    ``partition`` names a numeric column and its bounds for a stream that is to be cut by hand.
    """

    spark: SparkSession
    connection: Connection
    fetch_size: int = 10_000
    partition: dict[str, tuple[str, int, int, int]] | None = None
    parts: int = 1

    def _reader(self, query: str, stream: str = ""):
        options = self.connection.jdbc() | {"dbtable": f"({query}) AS t", "fetchsize": str(self.fetch_size)}
        if self.partition and stream in self.partition:
            column, low, high, n = self.partition[stream]
            options |= {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n)}
        return self.spark.read.format("jdbc").options(**options)

    def query(self, stream: StreamSpec, where: Sequence[str] = ()) -> str:
        """Raw predicates run in the database, each in parentheses, so its own dialect and indexes serve."""
        name = lambda x: '"' + x.replace('"', '""') + '"'
        kept = " AND ".join(f"({c})" for c in where)
        return f"SELECT {', '.join(map(name, stream.real_columns))} FROM {name(stream.schema)}.{name(stream.table)}" + (f" WHERE {kept}" if kept else "")

    def _ask(self, query: str) -> list[Row]:
        return self._reader(query).load().collect()

    def splits(self, stream: StreamSpec, parts: int) -> list[str]:
        """Predicates of a table's parts, by what the database knows of it; none for one part."""
        key = stream.replication_key if stream.replication_key in stream.real_columns else stream.keys[0] if stream.keys else None
        text = lambda x: x.replace("'", "''")
        if key:
            kind = {T.LongType(): "bigint", T.IntegerType(): "integer", T.ShortType(): "smallint", T.DateType(): "date", T.TimestampType(): "timestamptz", T.TimestampNTZType(): "timestamp"}.get(stream.type_of(key), "numeric" if isinstance(stream.type_of(key), T.DecimalType) else "text")
            rows = self._ask(splits.STATISTICS.format(schema=text(stream.schema), table=text(stream.table), column=text(key), kind=kind))
            if rows:
                points = tuple(splits.Point(r["value"], float(r["weight"]), r["common"]) for r in rows)
                column = '"' + key.replace('"', '""') + '"'
                return splits.predicates(column, splits.Statistics(points, float(rows[0]["nulls"])), parts)
        rows = self._ask(splits.PAGES.format(schema=text(stream.schema), table=text(stream.table)))
        return splits.page_predicates(int(rows[0]["relpages"]), parts) if rows else []

    def scan(self, stream: StreamSpec, where: Sequence[str] = ()) -> DataFrame:
        found = self.splits(stream, self.parts) if self.parts > 1 and stream.name not in (self.partition or {}) else []
        if not found:
            return self._reader(self.query(stream, where), stream.name).load()
        # Each part is a query of its own, so its condition stands beside the others and may name what isn't selected.
        options = {k: v for k, v in self.connection.jdbc().items() if k != "url"} | {"fetchsize": str(self.fetch_size)}
        parts = [self.spark.read.jdbc(self.connection.jdbc()["url"], f"({self.query(stream, [*where, p])}) AS t", properties=options) for p in found]
        return reduce(DataFrame.unionByName, parts)

    def discover(self, settings: Settings) -> Catalog:
        rows = self._reader(_COLUMNS).load().collect()
        wanted = set(schema_names({r["table_schema"] for r in rows}, settings))
        tables: dict[tuple[str, str], list] = {}
        for r in sorted(rows, key=lambda r: (r["table_schema"], r["table_name"], r["ordinal_position"])):
            if r["table_schema"] in wanted:
                tables.setdefault((r["table_schema"], r["table_name"]), []).append(r)
        streams = []
        for (schema, table), cols in tables.items():
            kinds: dict[str, T.DataType] = {c["column_name"]: spark_type(c["kind"]) for c in cols}
            flags = {"dates_as_string": settings.dates_as_string, "json_as_object": settings.json_as_object}
            props = {c["column_name"]: (nullable if c["is_nullable"] == "YES" else dict)(json_schema(kinds[c["column_name"]], **flags)) for c in cols}
            need = tuple(c["column_name"] for c in cols if c["is_nullable"] != "YES")
            streams.append(StreamSpec(schema, table, props, tuple(c["column_name"] for c in cols if c["is_key"]), need, settings.default_replication_method, types=kinds))
        return Catalog(streams)
