"""Runs: tables in full or from a bookmark, and one pass over the log for all its streams."""

from __future__ import annotations

import hashlib
import os
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import INCREMENTAL, LOG_BASED, Settings
from tidemark.functions.identifiers import quoted, table_filter
from tidemark.functions.values import iso_timestamp
from tidemark.operators.decode import EMITTED, JSON_TIMES, cells, record_values, rows_of
from tidemark.operators.dispatch import Routes, dispatched, emitted, position, quarantined
from tidemark.operators.table_stream import bootstrap, dates_as_text, flattened, in_order, new_bookmark, read_stream
from tidemark.plans.catalog import DELETED, LSN, Catalog, StreamSpec
from tidemark.plans.maps import Maps
from tidemark.sources import wal
from tidemark.sources.segments import Landing, land_in_task
from tidemark.sources.tables import Tables
from tidemark.streaming.schemas import Schemas
from tidemark.streaming.state import State, advance_to, current_tip, instant

#: Segments that are decoded at a time: what a batch keeps while it is written.
SEGMENTS_PER_BATCH = 32
#: What a landing task is given at least, so that runs with little time still get on.
LEAST_SECONDS = 1.0


#: From a stream and two positions to the keys that changes between them replace.
Changed = Callable[[StreamSpec, int, int], DataFrame]


@dataclass
class LogReport:
    """What a log run did."""

    counts: dict[str, int] = field(default_factory=dict)
    by_stream: dict[str, int] = field(default_factory=dict)
    max_seen: int = 0
    caught_up: bool = False
    advanced_to: int | None = None
    batches: int = 0

    def add(self, other: LogReport) -> None:
        for name, n in other.counts.items():
            self.counts[name] = self.counts.get(name, 0) + n
        self.by_stream |= other.by_stream
        self.max_seen = max(self.max_seen, other.max_seen)
        self.caught_up = self.caught_up and other.caught_up
        self.batches += other.batches


class LogRun:
    """One pass over the log for all its streams.

    A task lands the log as segments of whole transactions (``sources.segments``), and batches of segments are decoded in
    parallel.  Each batch is parsed once and kept while it is written; its entry in the sink's list of commits and its bookmarks
    are saved only after all writes, so what fails is done again and replaces what its first try left.  The number of jobs a
    batch takes doesn't depend on that of the streams.

    Time is looked at between batches, and a run does one at least if there is any, so a backlog of any size is worked off by
    runs of any length.  With ``landing``, a folder that stays, segments outlive the run and are confirmed to the server one by
    one; a log that can't be read twice needs it.  Without, they are in the scratch folder.

    Columns that appear in the log are taken up (``streaming.schemas``), or counted and set aside.  Rows with a value that their
    column's type can't hold go to the quarantine, the caller's or the sink's; without either they are emitted with a null and
    counted.
    """

    def __init__(self, spark: SparkSession, streams: Iterable[StreamSpec], state: State, sink, options: Mapping[str, str], settings: Settings | None = None, landing: str | None = None, quarantine: str | None = None, clock=None, now=None):
        self.spark, self.state, self.sink, self.settings = spark, state, sink, settings
        self.run_id = hashlib.sha256(landing.encode()).hexdigest()[:12] if landing else uuid.uuid4().hex[:12]
        self.landing, self.now = landing, now
        # What the sink holds may be ahead of the state: a run may have been lost between the two.
        for entry in sink.committed() if landing and hasattr(sink, "committed") else ():
            if entry.get("run") == self.run_id:
                state.merge(entry)
                state.decoded(landing, entry["segments"][1])
        self.schemas = Schemas(streams, state)
        self.routes = Routes(self.streams, {s.name: state.start(s.name) for s in self.streams}, {s.name: state.commit(s.name) for s in self.streams if state.commit(s.name) is not None})
        self.options = dict(options) | {"start_lsn": str(self.routes.global_start), "add_tables": self.routes.add_tables}
        self.maps = Maps(settings.stream_maps if settings else None)
        self.quarantine = quarantine or getattr(sink, "quarantine", None)
        self.clock = clock or time.monotonic
        self.report = LogReport(max_seen=0, by_stream={s.name: 0 for s in self.streams})
        self.done = False
        self._folder: str | None = landing
        self._at = -1
        self._wal_end: int | None = None

    @property
    def streams(self) -> list[StreamSpec]:
        return list(self.schemas.streams.values())

    def batch(self, log: DataFrame, number: int = 0, upto: int | None = None) -> None:
        """Decodes, writes, counts, commits and moves bookmarks, for a batch of ``lsn, payload`` with or without commits; ``upto`` is its last segment."""
        part = f"_run={self.run_id}/_batch={number}"
        messages = dispatched(log, self.routes).persist()
        try:
            stats = messages.groupBy("stream", "disposition").agg(F.count("*").alias("n"), F.max(position()).alias("top"), F.max("commit").alias("commit")).collect()
            if not stats:
                return
            counts: dict[str, int] = {}
            for r in stats:
                name = "emitted" if r["disposition"] in EMITTED else r["disposition"]
                counts[name] = counts.get(name, 0) + r["n"]
            seen = {name: [r for r in stats if r["stream"] == name and r["disposition"] in EMITTED] for name in {r["stream"] for r in stats if r["disposition"] in EMITTED}}
            new = self.schemas.new_columns(messages) if seen else {}
            if new and (self.settings is None or self.settings.evolve_schemas):
                self.schemas.grow(new)
                new = {}
            if seen:
                lost = self._write_all(messages, [s for s in self.streams if s.name in seen], part, new)
                counts |= {name: n for name, n in lost.items() if n}
            if self.quarantine and not (seen and hasattr(self.sink, "batch")):
                quarantined(messages).write.mode("overwrite").parquet(f"{self.quarantine}/{part}/_kind=message")
            for name, n in counts.items():
                self.report.counts[name] = self.report.counts.get(name, 0) + n
            for name, found in seen.items():
                self.report.by_stream[name] += sum(r["n"] for r in found)
                self.state.advance(name, LSN, max(r["top"] for r in found))
                self.state.done(name, max((r["commit"] for r in found if r["commit"] is not None), default=None))
            self.report.max_seen = max(self.report.max_seen, *(r["top"] or 0 for r in stats))
            self.report.batches += 1
            if hasattr(self.sink, "commit"):
                entry = {"run": self.run_id, "segments": [number, number if upto is None else upto], "streams": {t.name: sum(r["n"] for r in found) for name, found in seen.items() for t in self._targets([self.schemas.streams[name]])}}
                self.sink.commit(part, entry | {k: self.state.value[k] for k in ("bookmarks", "schemas") if k in self.state.value})
            self.state.save()
            self.sink.state(self.state.value)
        finally:
            messages.unpersist()

    def _write_all(self, messages: DataFrame, present: list[StreamSpec], part: str, unknown: dict[str, dict]) -> dict[str, int]:
        """Writes the rows of all streams; how many had a value that its type can't hold, or a column that isn't known.

        A sink that takes batches gets all by one job, and the quarantine is another; else each stream is written by itself.
        """
        if not hasattr(self.sink, "batch"):
            return {"uncastable": sum(self._write(messages, s, part) for s in present)}
        values = self._values(messages, present)
        names = {s: F.array(*map(F.lit, columns)) for s, columns in unknown.items()}
        strange = F.lit(False)
        if unknown:
            carried = F.transform(cells(F.col("msg")), lambda x: x["name"])
            for s, columns in names.items():
                strange = strange | ((F.col("stream") == s) & F.coalesce(F.arrays_overlap(carried, columns), F.lit(False)))
        if self.quarantine:
            # Rows that are set aside and messages that give none, in one table.
            bad = values.filter(F.size("lost") > 0).select("lsn", "payload", F.concat(F.lit("uncastable: "), F.array_join("lost", ", ")).alias("reason"))
            aside = quarantined(messages).unionByName(bad)
            if unknown:
                aside = aside.unionByName(messages.filter(F.col("disposition").isin(*EMITTED) & strange).select("lsn", "payload", F.lit("unknown column").alias("reason")))
            watched = Observation()
            aside.observe(watched, F.count_if(F.col("reason").startswith("uncastable")).alias("uncastable"), F.count_if(F.col("reason") == "unknown column").alias("unknown_column")).write.mode("overwrite").parquet(f"{self.quarantine}/{part}/_kind=message")
            lost = watched.get
            good = values.filter(F.size("lost") == 0)
        else:
            lost = {"uncastable": values.filter(F.size("lost") > 0).count(), "unknown_column": messages.filter(F.col("disposition").isin(*EMITTED) & strange).count() if unknown else 0}
            good = values
        self.sink.batch(good, self._targets(present), part)
        return lost

    def _targets(self, streams: list[StreamSpec]) -> list[StreamSpec]:
        return self.maps.specs(self.spark, streams)

    def _values(self, messages: DataFrame, present: list[StreamSpec]) -> DataFrame:
        """Rows of all streams as JSON text: those of streams without a map have their messages' columns, those of a map have its."""
        plain = [s for s in present if self.maps.plain(s.name)]
        made = [record_values(messages.filter(F.col("stream").isin([s.name for s in plain])), plain, self.now, self._shape)] if plain else []
        kept = ["payload", "_lost", "_commit", "_seq"]
        for s in present:
            for m in self.maps.of(s.name) if s not in plain else ():
                rows = rows_of(emitted(messages, s), s, self.now, carry_lost=True, carry_order=True).withColumn("_at", F.col(LSN))
                shaped = self._shaped(m.frame(rows, [*kept, "_at"]))
                record = F.struct(*(quoted(c).alias(c) for c in shaped.columns if c not in (*kept, "_at")))
                made.append(shaped.select(F.lit(m.spec(self.spark, s).name).alias("_stream"), F.coalesce("_commit", "_at").alias("position"), F.coalesce("_seq", F.lit(0).cast("bigint")).alias("seq"), F.col("_at").alias("lsn"), "payload", F.to_json(record, {"ignoreNullFields": "false", **JSON_TIMES}).alias("value"), F.col("_lost").alias("lost")))
        return reduce(DataFrame.unionByName, made)

    def _write(self, messages: DataFrame, s: StreamSpec, part: str) -> int:
        """Writes a stream's rows as a typed table; how many had a value that their types can't hold."""
        rows = rows_of(emitted(messages, s), s, self.now, carry_lost=True, carry_order=True)
        bad = rows.filter(F.size("_lost") > 0)
        lost = bad.count()
        if lost and self.quarantine:
            bad.select(F.col(LSN).alias("lsn"), "payload", F.concat(F.lit("uncastable: "), F.array_join("_lost", ", ")).alias("reason")).write.mode("overwrite").parquet(f"{self.quarantine}/{part}/_kind={s.name}")
            rows = rows.filter(F.size("_lost") == 0)
        ordered = rows.sortWithinPartitions(F.coalesce("_commit", LSN), "_seq", LSN).drop("payload", "_lost", "_commit", "_seq")
        for m in self.maps.of(s.name):
            self.sink.rows(s if self.maps.plain(s.name) else m.spec(self.spark, s), self._shaped(m.frame(ordered)))
        return lost

    def _shape(self, value: Column, kind: T.DataType) -> Column:
        """A value as the settings want it, for rows that are JSON text."""
        s = self.settings
        if s and s.dates_as_string and isinstance(kind, T.DateType):
            return value.cast("string")
        if s and s.dates_as_string and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return iso_timestamp(value)
        return F.to_json(value) if s and s.flattening_enabled and isinstance(kind, (T.MapType, T.VariantType)) else value

    def _shaped(self, rows: DataFrame) -> DataFrame:
        s = self.settings
        rows = dates_as_text(rows) if s and s.dates_as_string else rows
        return flattened(rows, s.flattening_max_depth) if s and s.flattening_enabled else rows

    def run(self) -> LogReport:
        """Until the log is drained and idle, or time is up. A second call does nothing: siblings share one run. A run that fails can be called again."""
        if self.done:
            return self.report
        s = self.settings
        most = s.replication_max_run_seconds if s else 600
        idle = s.replication_idle_exit_seconds if s else 0
        client = wal.client_of(self.options)
        if not getattr(client, "replayable", True) and not self.landing:
            raise ValueError("this log can't be read twice: a landing folder is needed")
        self.sink.schemas(self._targets(self.streams))
        self._folder = self._folder or scratch_folder(self.spark, "landing")
        landing = Landing(self._folder)
        confirm = bool(self.landing) and self.options.get("feedback", "true") == "true"
        begun = quiet = self.clock()
        left = lambda: most - (self.clock() - begun)
        # What an earlier run has landed comes first.
        all_done = self._decode(landing, left)
        while all_done:
            got = land_in_task(self.spark, self.options, self._folder, self.routes.global_start, max(LEAST_SECONDS, left()), float(self.options.get("idle_seconds", max(1.0, idle))), confirm=confirm)
            self._wal_end = got.wal_end
            all_done = self._decode(landing, left)
            if got.rows:
                quiet = self.clock()
            if not all_done or left() <= 0 and not (got.drained and idle == 0):
                break
            if got.drained and self.clock() - quiet >= idle:
                self.report.caught_up = True
                break
            if not got.drained and not got.rows:
                break  # silent, and not at its end: the next run goes on
            if got.drained:
                time.sleep(min(1.0, idle))
        self._advance(client)
        self.done = True
        return self.report

    def _decode(self, landing: Landing, left) -> bool:
        """Decodes what is landed, some segments at a time; whether all was done within the time."""
        most = int(self.options.get("segments_per_batch", SEGMENTS_PER_BATCH))
        if self.landing:
            self._at = max(self._at, self.state.landed(self.landing))
        while pending := landing.segments(self._at):
            some = pending[:most]
            self.batch(landing.frame(self.spark, some), some[0].number, some[-1].number)
            self._at = some[-1].number
            # A commit's position counts as seen even where none of its messages is wanted.
            self.report.max_seen = max(self.report.max_seen, *(s.last for s in some))
            if self.landing:
                self.state.decoded(self.landing, self._at)
                self.state.save()
            if left() <= 0:
                return len(pending) == len(some)
        return True

    def replay(self, landed: str, checkpoint: str, files_per_batch: int = 64) -> LogReport:
        """Decodes a log that was landed as Parquet by others, in micro-batches; what the checkpoint has seen isn't read again."""
        self.sink.schemas(self._targets(self.streams))
        self.run_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
        stream = self.spark.readStream.schema(wal.SCHEMA).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(landed)
        query = stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        self.report.caught_up = True
        return self.report

    def _advance(self, client: wal.WalClient) -> None:
        """Final feedback, then bookmarks; if the feedback fails they stay where the rows have put them."""
        start = self.routes.global_start
        # Not what the server would say now: changes that came since were not read.
        tip = current_tip(self._wal_end, start, lambda: None)
        target = advance_to(start, self.report.max_seen, tip, self.report.caught_up)
        if target is not None and self.options.get("acknowledge", "true") == "true":
            try:
                client.feedback(target)
            except Exception:  # whatever the client raises: the slot keeps its place
                target = None
        if target is not None:
            for s in self.streams:
                if (self.state.bookmark(s.name) or 0) < target:
                    self.state.advance(s.name, LSN, target)
            self.report.advanced_to = target
        self.state.save()
        self.sink.state(self.state.value)


class Engine:
    """Discovers, reads tables and runs the log, for the selected streams of a catalog."""

    def __init__(self, spark: SparkSession, settings: Settings, tables: Tables, state: State | None = None, catalog: Mapping[str, Any] | None = None):
        from tidemark.plans.catalog import Catalogs

        self.spark, self.settings, self.tables = spark, settings, tables
        self.state = state or State()
        self._catalogs = Catalogs(lambda: tables.discover(settings), catalog)
        self.maps = Maps(settings.stream_maps)

    @property
    def catalog(self) -> Catalog:
        return self._catalogs.get()

    def frame(self, spec: StreamSpec) -> DataFrame:
        """A table stream as a DataFrame, before its maps."""
        where = self.settings.where(spec.name)
        df = read_stream(self.tables.scan(spec, where), spec, self.settings, self.state.start(spec.name), where=())
        return flattened(df, self.settings.flattening_max_depth) if self.settings.flattening_enabled else df

    def _rows(self, sink, spec: StreamSpec, df: DataFrame, *part: str) -> None:
        """Rows of a stream as what its maps make of them."""
        for m in self.maps.of(spec.name):
            sink.rows(spec if self.maps.plain(spec.name) else m.spec(self.spark, spec), m.frame(df), *part)

    def sync_tables(self, sink) -> None:
        """Full and incremental streams; a bookmark moves after its rows are written.

        Flattening keeps the replication key's name, as only structs are flattened.
        """
        for spec in self.catalog.selected:
            if spec.method == LOG_BASED:
                continue
            df = self.frame(spec)
            key = spec.replication_key
            if spec.method != INCREMENTAL or not key:
                self._rows(sink, spec, df)
                continue
            # Rows and bookmark come from one read of the table: what is committed meanwhile is left to the next run.
            landed = scratch_folder(self.spark, "increment")
            df.write.parquet(landed)
            kept = self.spark.read.schema(df.schema).parquet(landed)
            self._rows(sink, spec, in_order(kept, key, *spec.keys))
            top = new_bookmark(kept, key, self.state.bookmark(spec.name)).first()[0]
            self.state.advance(spec.name, key, instant(top, kept.schema[key].dataType))
            self.state.save()
            sink.state(self.state.value)

    def bootstrap(self, specs: Iterable[StreamSpec], sink, client: wal.WalClient, changed: Changed | None = None) -> None:
        """A snapshot of streams that have no bookmark; the position is taken before, so changes overlap it but none is missed.

        Where the position can't be had, nothing is read.  With ``bootstrap_chunks`` a table is read in parts of its key, and
        the state says which are done: a snapshot that is broken off goes on where it was, from the position at which it began.
        """
        for spec in specs:
            if self.state.bookmark(spec.name) is not None:
                continue
            if self.settings.bootstrap_chunks > 1 or spec.name in self.state.value.get("bootstrap", {}):
                self._by_chunks(spec, sink, client, changed)
                continue
            tip = client.tip()
            if tip is None:
                continue
            where = self.settings.where(spec.name)
            self._rows(sink, spec, bootstrap(self.tables.scan(spec, where), spec))
            self.state.advance(spec.name, LSN, tip)
            self.state.save()

    def _by_chunks(self, spec: StreamSpec, sink, client: wal.WalClient, changed: Changed | None) -> None:
        """Chunks one after the other; rows that the log replaces as a whole while their chunk is read are left to the log."""
        kept = self.state.value.setdefault("bootstrap", {})
        if spec.name not in kept:
            tip = client.tip()
            if tip is None:
                return
            kept[spec.name] = {"low": tip, "chunks": self.tables.splits(spec, self.settings.bootstrap_chunks) or ["true"], "done": 0}
            self.state.save()
        progress = kept[spec.name]
        for i in range(progress["done"], len(progress["chunks"])):
            low = client.tip()
            landed = scratch_folder(self.spark, "chunk")
            rows = bootstrap(self.tables.scan(spec, [*self.settings.where(spec.name), progress["chunks"][i]]), spec)
            rows.write.parquet(landed)
            rows = self.spark.read.schema(rows.schema).parquet(landed)
            high = client.tip()
            if changed and spec.keys and low is not None and high is not None and high > low:
                rows = rows.join(changed(spec, low, high), list(spec.keys), "left_anti").select(*map(quoted, rows.columns))
            self._rows(sink, spec, rows, f"_chunk={i}")
            progress["done"] = i + 1
            self.state.save()
        self.state.advance(spec.name, LSN, progress["low"])
        del kept[spec.name]
        self.state.save()

    def _changes(self, options: Mapping[str, str], landing: str | None) -> Changed | None:
        """The keys of a stream that the log replaces or deletes as a whole between two positions. It lands the log for that, so a slot needs a landing that stays."""
        if not landing and not getattr(wal.client_of(options), "replayable", True):
            return None

        def changed(spec: StreamSpec, low: int, high: int) -> DataFrame:
            folder = landing or scratch_folder(self.spark, "changes")
            routes = Routes([spec])
            land_in_task(self.spark, dict(options) | {"add_tables": table_filter((s.schema, s.table) for s in self.catalog.selected if s.method == LOG_BASED)}, folder, low, 600, 1.0, confirm=False)
            found = Landing(folder)
            log = found.frame(self.spark, [s for s in found.segments() if s.last > low and s.first <= high])
            rows = rows_of(emitted(dispatched(log, routes).filter((position() > low) & (position() <= high)), spec), spec, carry_present=True)
            return rows.filter(F.col(DELETED).isNotNull() | (F.size(F.array_distinct("_present_cols")) >= len(spec.real_columns))).select(*map(quoted, spec.keys)).distinct()

        return changed

    def sync_log(self, sink, options: Mapping[str, str], **more) -> LogReport | None:
        """All schemas, then snapshots if wanted, then the log.

        With ``log_based_single_connection`` off, each stream reads the log for
        itself, with a landing folder of its own; the server hears of it
        once, when all have read, for a slot forgets what it is told was read.
        """
        specs = [s for s in self.catalog.selected if s.method == LOG_BASED]
        if not specs:
            return None
        sink.schemas(self.maps.specs(self.spark, specs))
        if self.settings.auto_bootstrap_log_based:
            self.bootstrap(specs, sink, wal.client_of(options), self._changes(options, more.get("landing")))
        for s in specs:
            self.state.mark_start(s.name, LSN, self.state.bookmark(s.name))
        options = {"slot": self.settings.replication_slot_name, "idle_seconds": str(max(1.0, self.settings.replication_idle_exit_seconds)), **options}
        if self.settings.log_based_single_connection:
            return LogRun(self.spark, specs, self.state, sink, options, self.settings, **more).run()
        total, reached = LogReport(caught_up=True), []
        for s in specs:
            own = {k: f"{v}/{s.name}" if k in ("landing", "quarantine") and v else v for k, v in more.items()}
            one = LogRun(self.spark, [s], self.state, sink, options | {"feedback": "false", "acknowledge": "false"}, self.settings, **own).run()
            total.add(one)
            reached.append(self.state.bookmark(s.name) or 0)
        if min(reached) > 0:
            try:
                wal.client_of(options).feedback(min(reached))
                total.advanced_to = min(reached)
            except Exception:  # whatever the client raises: the slot keeps its place, and the next run reads again
                total.advanced_to = None
        return total


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see: below the cluster's checkpoint folder. A local session may do without; its folder is a temporary one."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        root = tempfile.mkdtemp(prefix="tidemark-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def state_file(folder: str) -> State:
    return State(os.path.join(folder, "state.json"))
