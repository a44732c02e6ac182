"""Schemas of streams as a log goes on: columns that appear in its messages become versions of a stream's schema."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame

from tidemark.functions.types import json_schema, nullable, spark_type
from tidemark.operators.decode import columns_seen
from tidemark.plans.catalog import DELETED, LSN, StreamSpec
from tidemark.streaming.state import State


def with_columns(spec: StreamSpec, columns: dict[str, str]) -> StreamSpec:
    """A change-log stream with more columns, given by the database's names of their types; they stand before the log's own two."""
    types = {c: spark_type(kind) for c, kind in columns.items()}
    own = {c: p for c, p in spec.properties.items() if c in (DELETED, LSN)}
    props = {c: p for c, p in spec.properties.items() if c not in own} | {c: nullable(json_schema(t)) for c, t in types.items()} | own
    return replace(spec, properties=props, types=dict(spec.types) | types)


class Schemas:
    """The streams of a run, each in its newest version. Versions are kept in the state: ``schemas``, a list a stream of ``from`` and ``columns``."""

    def __init__(self, streams: Iterable[StreamSpec], state: State):
        self.state = state
        self.streams = {s.name: s for s in streams}
        for name in self.streams:
            for version in state.value.get("schemas", {}).get(name, []):
                self.streams[name] = with_columns(self.streams[name], version["columns"])

    def new_columns(self, messages: DataFrame) -> dict[str, dict[str, Any]]:
        """For each stream of a batch that has any: its columns that no version knows, with type and first position. Deselected columns are known."""
        found: dict[str, dict[str, Any]] = {}
        for r in columns_seen(messages).collect():
            if r["name"] is not None and r["name"] not in self.streams[r["stream"]].properties:
                found.setdefault(r["stream"], {})[r["name"]] = (r["type"], r["position"])
        return found

    def grow(self, found: dict[str, dict[str, Any]]) -> None:
        """A new version of each stream that has new columns."""
        for stream, columns in found.items():
            kinds = {c: kind or "text" for c, (kind, _) in sorted(columns.items(), key=lambda x: (x[1][1], x[0]))}
            self.streams[stream] = with_columns(self.streams[stream], kinds)
            version = {"from": min(at for _, at in columns.values()), "columns": kinds}
            self.state.value.setdefault("schemas", {}).setdefault(stream, []).append(version)
