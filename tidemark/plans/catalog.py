"""Streams and their catalog: discovery, selection, JSON round trip, change-log schemas."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.config import FULL_TABLE, LOG_BASED, METHODS, Settings
from tidemark.functions.identifiers import route_name
from tidemark.functions.types import from_json_schema, json_schema, nullable

#: Columns that a change log adds: when a row was deleted, and where in the log it was.
DELETED, LSN = "_sdc_deleted_at", "_sdc_lsn"


@dataclass(frozen=True)
class StreamSpec:
    """One table or view: its columns as JSON Schema and as Spark types, keys, selection, method."""

    schema: str
    table: str
    properties: Mapping[str, dict[str, Any]]
    keys: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    method: str = FULL_TABLE
    replication_key: str | None = None
    selected: bool = True
    deselected: frozenset[str] = frozenset()
    types: Mapping[str, T.DataType] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.schema}-{self.table}"

    @property
    def route(self) -> str:
        return route_name(self.schema, self.table)

    @property
    def columns(self) -> list[str]:
        """Selected columns; keys and the replication key always are."""
        kept = {*self.keys, self.replication_key}
        return [c for c in self.properties if c not in self.deselected or c in kept]

    @property
    def real_columns(self) -> list[str]:
        return [c for c in self.columns if not c.startswith("_sdc_")]

    def type_of(self, column: str) -> T.DataType:
        return self.types.get(column) or from_json_schema(self.properties[column])

    def as_log_based(self) -> StreamSpec:
        """Every column may be null (a delete has only identity columns), none is required, two are added."""
        props = {c: nullable(p) for c, p in self.properties.items()}
        props |= {DELETED: {"type": ["string", "null"]}, LSN: {"type": ["integer", "null"]}}
        return replace(self, properties=props, required=(), method=LOG_BASED, replication_key=LSN, types=dict(self.types) | {DELETED: T.StringType(), LSN: T.LongType()})

    def to_json_schema(self) -> dict[str, Any]:
        out: dict[str, Any] = {"type": "object", "properties": {c: self.properties[c] for c in self.columns}}
        if self.required:
            out["required"] = [c for c in self.required if c in self.columns]
        return out

    def to_entry(self) -> dict[str, Any]:
        """The stream as a catalog entry."""

        def inclusion(c: str) -> str:
            return "automatic" if c in self.keys or c == self.replication_key else "available"

        top = {"breadcrumb": [], "metadata": {"inclusion": "available", "selected": self.selected, "schema-name": self.schema, "table-key-properties": list(self.keys), "forced-replication-method": self.method}}
        return {
            "tap_stream_id": self.name, "stream": self.name, "table_name": self.table, "key_properties": list(self.keys), "replication_method": self.method, "replication_key": self.replication_key,
            "schema": {"type": "object", "properties": dict(self.properties), "required": list(self.required)},
            "metadata": [*({"breadcrumb": ["properties", c], "metadata": {"inclusion": inclusion(c), "selected": c not in self.deselected} | ({"spark-type": self.types[c].jsonValue()} if c in self.types else {})} for c in self.properties), top],
        }

    @classmethod
    def of_entry(cls, entry: Mapping[str, Any]) -> StreamSpec:
        by = {tuple(m["breadcrumb"]): m["metadata"] for m in entry.get("metadata", [])}
        top = by.get((), {})
        props = entry["schema"]["properties"]
        name, table = entry["tap_stream_id"], entry.get("table_name")
        schema = top.get("schema-name") or (name[: -len(table) - 1] if table and name.endswith(f"-{table}") else name.partition("-")[0])
        off = frozenset(c for c in props if by.get(("properties", c), {}).get("selected", True) is False and by.get(("properties", c), {}).get("inclusion") != "automatic")
        method = entry.get("replication_method") or top.get("forced-replication-method") or FULL_TABLE
        if method not in METHODS:
            raise ValueError(f"no such replication method: {method!r}")
        types = {c: _type_of_json(by[("properties", c)]["spark-type"]) for c in props if "spark-type" in by.get(("properties", c), {})}
        return cls(schema, table or name.partition("-")[2], props, tuple(entry.get("key_properties") or ()), tuple(entry["schema"].get("required", ())), method, entry.get("replication_key"), bool(top.get("selected", entry.get("selected", True))), off, types)


def _type_of_json(kind: Any) -> T.DataType:
    """A column's type as an entry of our own discovery has it."""
    return T.StructType.fromJson({"type": "struct", "fields": [{"name": "x", "type": kind, "nullable": True, "metadata": {}}]})["x"].dataType


def of_frame(schema: str, table: str, df: DataFrame, settings: Settings | None = None, keys: Iterable[str] = ()) -> StreamSpec:
    """A stream from a table's Spark schema."""
    flags = {"dates_as_string": bool(settings and settings.dates_as_string), "json_as_object": bool(settings and settings.json_as_object)}
    props = {}
    for f in df.schema.fields:
        prop = json_schema(f.dataType, **flags)
        props[f.name] = nullable(prop) if f.nullable and f.name not in set(keys) else prop
    method = settings.default_replication_method if settings else FULL_TABLE
    required = tuple(f.name for f in df.schema.fields if not f.nullable or f.name in set(keys))
    return StreamSpec(schema, table, props, tuple(keys), required, method, types={f.name: f.dataType for f in df.schema.fields})


def schema_names(existing: Iterable[str], settings: Settings) -> list[str]:
    """The wanted schemas as they are given, whether they exist or not; without, all there are."""
    return list(settings.filter_schemas) or list(existing)


@dataclass
class Catalog:
    streams: list[StreamSpec]

    def to_dict(self) -> dict[str, Any]:
        return {"streams": [s.to_entry() for s in self.streams]}

    @classmethod
    def of_dict(cls, catalog: Mapping[str, Any]) -> Catalog:
        return cls([StreamSpec.of_entry(e) for e in catalog["streams"]])

    @property
    def selected(self) -> list[StreamSpec]:
        return [s for s in self.streams if s.selected]

    def get(self, name: str) -> StreamSpec:
        return next(s for s in self.streams if s.name == name)

    def log_based(self) -> Catalog:
        """Streams of that method with their change-log columns."""
        return Catalog([s.as_log_based() if s.method == LOG_BASED else s for s in self.streams])


class Catalogs:
    """A catalog that is given wins over one that is discovered; either is kept."""

    def __init__(self, discover, given: Mapping[str, Any] | None = None):
        self._discover, self._given, self._kept = discover, given, None

    def get(self) -> Catalog:
        if self._kept is None:
            self._kept = (Catalog.of_dict(self._given) if self._given is not None else self._discover()).log_based()
        return self._kept
