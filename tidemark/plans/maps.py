"""Stream maps of the settings, compiled to plans and to the schemas that these imply.

``stream_maps`` has by stream a dict of columns and SQL expressions: null drops a
column, an expression makes or replaces one from the columns as they were.
Beside them: ``__filter__`` keeps rows, ``__key_properties__`` are the keys,
``__alias__`` is the name to write under, ``__source__`` names another stream that
this one is made of too, ``__else__`` (null) drops all columns that aren't named.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.types import json_schema, nullable
from tidemark.operators.table_stream import mapped
from tidemark.plans.catalog import DELETED, LSN, StreamSpec

_SPECIAL = ("__filter__", "__key_properties__", "__alias__", "__source__", "__else__")


@dataclass(frozen=True)
class StreamMap:
    """One target: rules by column, what is kept, and under which name."""

    source: str
    rules: Mapping[str, str | None]
    keep: str | None = None
    keys: tuple[str, ...] | None = None
    alias: str | None = None
    otherwise_drop: bool = False

    @classmethod
    def of(cls, name: str, config: Mapping[str, Any]) -> StreamMap:
        if unknown := [c for c in config if c.startswith("__") and c not in _SPECIAL]:
            raise ValueError(f"stream map {name}: unknown {', '.join(unknown)}")
        if "__else__" in config and config["__else__"] is not None:
            raise ValueError(f"stream map {name}: __else__ can only be null")
        rules = {c: e for c, e in config.items() if c not in _SPECIAL}
        lower = [c.lower() for c in rules]
        if twice := sorted({c for c in lower if lower.count(c) > 1}):
            raise ValueError(f"stream map {name}: more than one column named {', '.join(twice)}")
        source = config.get("__source__")
        alias = config.get("__alias__") or (name if source else None)
        keys = config.get("__key_properties__")
        return cls(source or name, rules, config.get("__filter__"), None if keys is None else tuple(keys), alias, "__else__" in config)

    def frame(self, df: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
        """The mapped rows. The log's own columns stay, whatever else is dropped, and those to ``carry``."""
        rules = dict(self.rules)
        if self.otherwise_drop:
            rules |= {c: f"`{c}`" for c in df.columns if c in (DELETED, LSN, *carry) and c not in rules}
        return mapped(df, rules, self.keep, self.otherwise_drop)

    def spec(self, spark: SparkSession, spec: StreamSpec) -> StreamSpec:
        """The stream that comes of it: its columns and types are those of the plan over an empty table."""
        columns = [c for c in spec.columns]
        out = self.frame(spark.createDataFrame([], T.StructType([T.StructField(c, spec.type_of(c)) for c in columns]))).schema
        props = {f.name: spec.properties[f.name] if f.name in spec.properties and f.name not in self.rules else nullable(json_schema(f.dataType)) for f in out.fields}
        keys = spec.keys if self.keys is None else self.keys
        if gone := [k for k in keys if k not in props] if self.keys is not None else []:
            raise ValueError(f"stream map {spec.name}: no column {', '.join(gone)} for a key")
        schema, table = (self.alias.partition("-")[0], self.alias.partition("-")[2]) if self.alias and "-" in self.alias else (spec.schema, self.alias or spec.table)
        kept = {c for c in props if c not in self.rules}
        return replace(
            spec, schema=schema, table=table, properties=props, keys=tuple(k for k in keys if k in props), required=tuple(c for c in spec.required if c in kept),
            replication_key=spec.replication_key if spec.replication_key in props else None, deselected=frozenset(), types={f.name: f.dataType for f in out.fields},
        )


class Maps:
    """All maps of the settings. A stream without one is itself."""

    def __init__(self, config: Mapping[str, Mapping[str, Any] | None] | None):
        # A stream that is mapped to null isn't written; one that is only a source for others is written too.
        self.off = {name for name, c in (config or {}).items() if c is None}
        self.maps = {name: StreamMap.of(name, c) for name, c in (config or {}).items() if c is not None}

    def of(self, stream: str) -> list[StreamMap]:
        """What a stream becomes: itself or its own map, and the streams that are made of it."""
        own = [m for name, m in self.maps.items() if name == stream and m.source == stream]
        more = [m for name, m in self.maps.items() if name != stream and m.source == stream]
        return ([] if stream in self.off else own or [StreamMap(stream, {})]) + more

    def plain(self, stream: str) -> bool:
        """Whether a stream is written as it is, and only so."""
        return self.of(stream) == [StreamMap(stream, {})]

    def specs(self, spark: SparkSession, streams: Iterable[StreamSpec]) -> list[StreamSpec]:
        """The streams that are written; of equal names there is none twice."""
        found = [s if self.plain(s.name) else m.spec(spark, s) for s in streams for m in self.of(s.name)]
        names = [s.name for s in found]
        if twice := sorted({n for n in names if names.count(n) > 1}):
            raise ValueError(f"stream maps write more than one stream named {', '.join(twice)}")
        return found
