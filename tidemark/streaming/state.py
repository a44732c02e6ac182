"""Progress: bookmarks that only move forward, and where they may move to."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Mapping
from datetime import date, datetime, timezone
from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def advance_to(start: int, max_seen: int, tip: int | None, caught_up: bool) -> int | None:
    """Where bookmarks may move after a run, None for nowhere.

    Only a run that has read all there was may move to the tip of the log, and
    never behind rows it has emitted; one that ran out of time moves to what it
    has seen.
    """
    target = max(tip or 0, max_seen) if caught_up else max_seen
    return target if target > start else None


def advance_column(start: Column, max_seen: Column, tip: Column, caught_up: Column) -> Column:
    """As ``advance_to``, for a table of runs."""
    target = F.when(caught_up, F.greatest(F.coalesce(tip, F.lit(0)), max_seen)).otherwise(max_seen)
    return F.when(target > start, target)


def stored(value: Any | None) -> Any | None:
    """A bookmark as the state file has it: times as ISO text (those of a zone in UTC), numbers that JSON can't hold exactly as text."""
    if isinstance(value, datetime):
        return value.isoformat(timespec="microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return str(value) if isinstance(value, Decimal) else value


def instant(value: Any | None, kind: T.DataType | None) -> Any | None:
    """A collected timestamp of a zone-aware column as a moment in UTC; anything else as it is."""
    return value.astimezone(timezone.utc) if isinstance(kind, T.TimestampType) and isinstance(value, datetime) else value


def like(old: Any | None, new: Any | None) -> Any | None:
    """A stored bookmark as a value of the kind that it is to be compared with."""
    if not isinstance(old, str) or isinstance(new, str) or new is None:
        return old
    if isinstance(new, datetime):
        found = datetime.fromisoformat(old)
        return found if (found.tzinfo is None) == (new.tzinfo is None) else found.replace(tzinfo=new.tzinfo)
    return date.fromisoformat(old) if isinstance(new, date) else type(new)(old)


def forward(old: Any | None, new: Any | None) -> Any | None:
    """The later of two bookmarks; None is before all."""
    return old if new is None else new if old is None else max(old, new)


def forward_column(old: Column, new: Column) -> Column:
    return F.greatest(old, new)


def current_tip(wal_end: int | None, start: int, ask) -> int | None:
    """What the connection has told if that is news, else what the server says when asked."""
    return wal_end if wal_end is not None and wal_end > start else ask()


class State:
    """Bookmarks by stream, as a dict, in a file that is replaced as a whole.

    It belongs to the driver.  Within a deployment a streaming checkpoint rules;
    this seeds its first offset.
    """

    def __init__(self, path: str | None = None, value: Mapping[str, Any] | None = None):
        self.path = path
        self.value: dict[str, Any] = {"bookmarks": {}}
        if value is not None:
            self.value = {**value, "bookmarks": {k: dict(v) for k, v in value.get("bookmarks", {}).items()}}
        elif path and os.path.exists(path):
            with open(path) as f:
                self.value = json.load(f)

    def bookmark(self, stream: str) -> Any | None:
        return self.value["bookmarks"].get(stream, {}).get("replication_key_value")

    def start(self, stream: str) -> Any | None:
        found = self.value["bookmarks"].get(stream, {})
        return found.get("replication_key_value", found.get("starting_replication_value"))

    def mark_start(self, stream: str, key: str, value: Any | None) -> None:
        self.value["bookmarks"].setdefault(stream, {}).update(replication_key=key, starting_replication_value=value)

    def advance(self, stream: str, key: str, value: Any | None) -> bool:
        """Moves a bookmark forward; an older or equal value, or None, moves nothing. Values are compared as what they are and kept as the file has them."""
        entry = self.value["bookmarks"].setdefault(stream, {})
        old = like(entry.get("replication_key_value"), value)
        new = forward(old, value)
        if new is not None:
            entry.update(replication_key=key, replication_key_value=stored(new))
        return new != old

    def commit(self, stream: str) -> int | None:
        """The last commit that a stream has done: nothing of it is wanted again."""
        return self.value["bookmarks"].get(stream, {}).get("commit")

    def done(self, stream: str, commit: int | None) -> None:
        if commit is not None:
            entry = self.value["bookmarks"].setdefault(stream, {})
            entry["commit"] = forward(entry.get("commit"), commit)

    def landed(self, folder: str) -> int:
        """The last segment of a landing folder that has been decoded, -1 for none."""
        return self.value.get("landed", {}).get(folder, -1)

    def decoded(self, folder: str, number: int) -> None:
        self.value.setdefault("landed", {})[folder] = max(number, self.landed(folder))

    def merge(self, other: Mapping[str, Any]) -> None:
        """Takes over what another state has further on."""
        for stream, entry in other.get("bookmarks", {}).items():
            if "replication_key_value" in entry:
                self.advance(stream, entry.get("replication_key"), entry["replication_key_value"])
            self.done(stream, entry.get("commit"))
        for stream, versions in other.get("schemas", {}).items():
            have = self.value.setdefault("schemas", {})
            have[stream] = max(have.get(stream, []), versions, key=len)

    def save(self) -> None:
        if not self.path:
            return
        folder = os.path.dirname(os.path.abspath(self.path))
        os.makedirs(folder, exist_ok=True)
        handle, name = tempfile.mkstemp(dir=folder, prefix=".state-")
        with os.fdopen(handle, "w") as f:
            json.dump(self.value, f, default=str, sort_keys=True)
            f.flush()
            os.fsync(f.fileno())
        os.replace(name, self.path)


def bookmarks_of(df: DataFrame, stream_col: str, key: str) -> DataFrame:
    """The greatest key of each stream: ``stream, bookmark``."""
    return df.groupBy(F.col(stream_col).alias("stream")).agg(F.max(key).alias("bookmark"))
