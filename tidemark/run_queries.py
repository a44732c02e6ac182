"""Queries that show as rows what runs, bookmarks, snapshots and catalogs give, and their SQL."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import queries as base
from tidemark.config import INCREMENTAL, LOG_BASED, Settings
from tidemark.functions.types import from_json_schema
from tidemark.functions.values import array_items, typed, utc_second
from tidemark.operators import messages
from tidemark.operators.dispatch import Routes
from tidemark.operators.images import filled, latest
from tidemark.plans.catalog import Catalog, Catalogs, StreamSpec, of_frame
from tidemark.sources import splits, wal
from tidemark.sources.connection import Connection
from tidemark.sources.tables import JdbcTables
from tidemark.streaming.run import Engine, LogRun, scratch_folder
from tidemark.streaming.state import State

_URL = "postgresql://u:p@localhost/db"
#: For runs that are to end at the log's end, however long it is, and not by the clock.
_UNTIL_DRAINED = Settings(url=_URL, replication_max_run_seconds=float("inf"), replication_idle_exit_seconds=0)


def _again(state: State) -> State:
    """The state as the next run finds it in its file."""
    return State(value=json.loads(json.dumps(state.value)))


def _log_folder(spark: SparkSession, sf_dir: str, upto: str = "true", two_tables: bool = False) -> str:
    """The events' log as a folder that the streaming source reads."""
    path = f"{scratch_folder(spark, 'log')}/log"
    base.event_log(spark, sf_dir, two_tables).select("lsn", "payload").filter(upto).repartitionByRange("lsn").sortWithinPartitions("lsn").write.json(path)
    return path


def _middle(spark: SparkSession, sf_dir: str) -> int:
    return spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.max("event_id")).first()[0] // 2


def wal_source_run(spark, sf_dir):
    """The log by the streaming source, in two runs: the second begins at the first one's bookmark, whose message is given again."""
    middle, state = _middle(spark, sf_dir), State()
    sink = messages.FileSink(scratch_folder(spark, "wal-source"), "parquet", None)
    for upto in (f"lsn <= {middle}", "true"):
        LogRun(spark, [base.event_stream()], state, sink, {"path": _log_folder(spark, sf_dir, upto)}, now=F.lit(base.NOW)).run()
        state = _again(state)
    return sink.frame(base.event_stream())


def wal_idle_run(spark, sf_dir):
    """A run that waits for more after it has read all: nothing is read twice. Rows, batches and where it ended."""
    settings = Settings(url=_URL, replication_idle_exit_seconds=2)
    sink = messages.FileSink(scratch_folder(spark, "wal-idle"), "parquet", None)
    report = LogRun(spark, [base.event_stream()], State(), sink, {"path": _log_folder(spark, sf_dir)}, settings, now=F.lit(base.NOW)).run()
    rows = sink.frame(base.event_stream())
    return rows.agg(F.count("*").alias("n"), F.countDistinct("_sdc_lsn").alias("positions")).withColumns({"emitted": F.lit(report.counts["emitted"]).cast("long"), "caught_up": F.lit(report.caught_up), "advanced_to": F.lit(report.advanced_to).cast("long")})


def wal_retried_batch(spark, sf_dir):
    """A batch that is run again replaces what its first try has written."""
    sink = messages.FileSink(scratch_folder(spark, "wal-retry"), "parquet", None)
    run = LogRun(spark, [base.event_stream()], State(), sink, {}, now=F.lit(base.NOW))
    for _ in range(2):
        run.batch(base.event_log(spark, sf_dir).select("lsn", "payload"), 3)
    return sink.frame(base.event_stream())


class Mute(wal.DirectoryLog):
    """A log that can't be told anything."""

    def feedback(self, lsn: int) -> None:
        raise OSError("no one listens")


def _halves(spark, sf_dir: str) -> str:
    """The events' log in two transactions, the first of the events up to the middle; a folder."""
    behind = F.col("lsn") > _middle(spark, sf_dir)
    log = base.event_log(spark, sf_dir).select("lsn", "payload")
    first, last = log.agg(F.max(F.when(~behind, F.col("lsn"))), F.max("lsn") + 1).first()
    commit = F.when(behind, last).otherwise(first)
    frames = spark.createDataFrame([(at, f'{{"action":"{kind}"}}', at, place) for at in (first, last) for kind, place in (("B", 0), ("C", 2))], "lsn long, payload string, commit long, kind int")
    return _as_folder(spark, frames.unionByName(log.select("lsn", "payload", commit.alias("commit"), F.lit(1).alias("kind"))))


def wal_run_ends(spark, sf_dir):
    """Runs that drain the log, whose time is up behind its first half, whose feedback fails, and that find nothing for their stream.

    Time is looked at between transactions, so a run without any does the first, which is half of the log.
    """
    rows, quiet = [], replace(base.event_stream(), table="quiet")
    no_time = Settings(url=_URL, replication_max_run_seconds=0, replication_idle_exit_seconds=0)
    cases = [
        ("drained", base.event_stream(), _UNTIL_DRAINED, _log_folder, {}),
        ("out of time", base.event_stream(), no_time, _halves, {"segment_rows": "1", "segments_per_batch": "1"}),
        ("unheard", base.event_stream(), _UNTIL_DRAINED, _log_folder, {"client": "tidemark.run_queries:Mute", "feedback": "false"}),
        ("quiet", quiet, _UNTIL_DRAINED, _log_folder, {}),
    ]
    for name, spec, settings, folder, more in cases:
        path, state = folder(spark, sf_dir), State()
        report = LogRun(spark, [spec], state, messages.FrameSink(), {"path": path, **more}, settings).run()
        rows.append((name, report.caught_up, report.advanced_to, wal.DirectoryLog({"path": path}).acknowledged(), state.bookmark(spec.name)))
    return spark.createDataFrame(rows, "run string, caught_up boolean, advanced_to long, confirmed long, bookmark long")


def _change(action, *cells):
    """A message of the events' stream, of the cells that aren't null."""
    return F.to_json(F.struct(action.alias("action"), F.lit("public").alias("schema"), F.lit("events").alias("table"), F.filter(F.array(*cells), lambda c: c.isNotNull()).alias("columns")))


def transaction_log(spark, sf_dir: str) -> DataFrame:
    """The events' log in transactions that overlap: ``lsn, payload`` with frames, and the commit that each line belongs to.

    Seven transactions are open at a time, each of ten events in a row of every seventh; the one that began first commits last.
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    group, place = F.floor(F.col("event_id") / 70), F.col("event_id") % 7
    commit = ((group + 1) * 70 * 10 + 7 - place).cast("long")
    change = base.event_log(spark, sf_dir).select((F.col("lsn") * 10).alias("lsn"), "payload", F.col("lsn").alias("event_id")).withColumn("commit", ((F.floor(F.col("event_id") / 70) + 1) * 70 * 10 + 7 - F.col("event_id") % 7).cast("long"))
    commits = e.select(commit.alias("commit"), (F.col("event_id") * 10).alias("lsn")).groupBy("commit").agg(F.min("lsn").alias("first"))
    begin = commits.select(F.col("first").alias("lsn"), F.lit('{"action":"B"}').alias("payload"), "commit", F.lit(0).alias("kind"))
    end = commits.select(F.col("commit").alias("lsn"), F.lit('{"action":"C"}').alias("payload"), "commit", F.lit(2).alias("kind"))
    return begin.unionByName(end).unionByName(change.select("lsn", "payload", "commit", F.lit(1).alias("kind")))


def _as_folder(spark, log: DataFrame) -> str:
    path = f"{scratch_folder(spark, 'log')}/log"
    log.repartitionByRange("commit", "kind", "lsn").sortWithinPartitions("commit", "kind", "lsn").select("lsn", "payload").write.json(path)
    return path


def wal_interleaved_transactions(spark, sf_dir):
    """Overlapping transactions over several batches and two runs, the second of which finds a longer log: each row once, in the order of commits."""
    log, state = transaction_log(spark, sf_dir), State()
    half = log.agg(F.max("commit")).first()[0] // 1400 * 700
    sink = messages.FileSink(scratch_folder(spark, "wal-transactions"), "parquet", None)
    for some in (log.filter(F.col("commit") <= half), log):
        options = {"path": _as_folder(spark, some), "segment_rows": str(half // 100 + 7), "segments_per_batch": "2", "file_chars": "4000"}
        LogRun(spark, [base.event_stream()], state, sink, options, now=F.lit(base.NOW)).run()
        state = _again(state)
    return sink.frame(base.event_stream())


def wal_time_budget(spark, sf_dir):
    """Runs without time, one after the other, until one is at the log's end: each lands a little and decodes a batch. Rows, positions, and whether it took several runs."""
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    folder, state, runs = scratch_folder(spark, "wal-budget"), State(), 0
    sink = messages.FileSink(f"{folder}/out", "parquet", None)
    options = {"path": _log_folder(spark, sf_dir), "segment_rows": str(n // 3 + 1), "segments_per_batch": "1"}
    caught_up = False
    while not caught_up:
        before = state.landed(f"{folder}/landing")
        report = LogRun(spark, [base.event_stream()], state, sink, options, Settings(url=_URL, replication_max_run_seconds=0, replication_idle_exit_seconds=0), landing=f"{folder}/landing").run()
        caught_up, runs, state = report.caught_up, runs + 1, _again(state)
        if not caught_up and state.landed(f"{folder}/landing") == before:
            raise RuntimeError(f"run {runs} decoded nothing, and the log isn't at its end")
    rows = sink.frame(base.event_stream())
    return rows.agg(F.count("*").alias("n"), F.countDistinct("_sdc_lsn").alias("positions")).withColumns({"several": F.lit(runs >= 3), "caught_up": F.lit(caught_up), "bookmark": F.lit(state.bookmark("public-events")).cast("long")})


def _updates(spark, sf_dir) -> DataFrame:
    """A log of users' rows: each event of a user changes it. Every third leaves ``value`` out, every fifth sets it to null."""
    e, eid = spark.read.parquet(f"{sf_dir}/events.parquet"), F.col("event_id")
    value = F.when(eid % 3 != 0, base._cell("value", "double precision", F.when(eid % 5 != 0, F.col("value"))))
    cells = (base._cell("event_id", "bigint", eid), base._cell("user_id", "bigint", F.col("user_id")), value, base._cell("event_type", "text", F.col("event_type")))
    # Nulls of a cell must be in the message, so the JSON keeps them; what isn't there is no cell.
    payload = F.to_json(F.struct(F.lit("U").alias("action"), F.lit("public").alias("schema"), F.lit("events").alias("table"), F.filter(F.array(*cells), lambda c: c.isNotNull()).alias("columns")), {"ignoreNullFields": "false"})
    return e.select(eid.alias("lsn"), payload.alias("payload"))


def wal_set_null(spark, sf_dir):
    """Lines of the file: a column that was set to null is null there, one that the message lacks isn't there."""
    sink = messages.FileSink(scratch_folder(spark, "wal-null"))
    LogRun(spark, [base.event_stream()], State(), sink, {}, now=F.lit(base.NOW)).batch(_updates(spark, sf_dir))
    lines = spark.read.text(f"{sink.folder}/_log/{sink.committed()[0]['part']}").select("value", F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))
    there = F.array_contains(F.json_object_keys("value"), "value")
    return lines.select("event_id", there.alias("there"), (there & F.col("value").contains('"value":null')).alias("null"))


def wal_unchanged_columns(spark, sf_dir):
    """A user's value after each of its events: one that the message lacks is as before, one that was set to null is null."""
    sink = messages.FileSink(scratch_folder(spark, "wal-unchanged"), "parquet", None)
    LogRun(spark, [base.event_stream()], State(), sink, {}, now=F.lit(base.NOW)).batch(_updates(spark, sf_dir))
    rows = filled(sink.frame(base.event_stream(), presence=True), ["user_id"], ["value", "event_type"], scratch_folder(spark, "images"))
    return rows.select("event_id", "user_id", "value", "event_type")


def wal_latest_rows(spark, sf_dir):
    """Users' rows as they stand behind all events."""
    sink = messages.FileSink(scratch_folder(spark, "wal-latest"), "parquet", None)
    LogRun(spark, [base.event_stream()], State(), sink, {}, now=F.lit(base.NOW)).batch(_updates(spark, sf_dir))
    return latest(sink.frame(base.event_stream(), presence=True), ["user_id"], ["event_id", "value", "event_type"])


def wal_added_column(spark, sf_dir):
    """A column that appears in the middle of the log: rows have it from there on, and the schema is announced again."""
    middle, eid = _middle(spark, sf_dir), F.col("event_id")
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = (base._cell("event_id", "bigint", eid), base._cell("user_id", "bigint", F.col("user_id")), F.when(eid > middle, base._cell("score", "integer", F.col("user_id") * 2)))
    log = e.select(eid.alias("lsn"), _change(F.lit("I"), *cells).alias("payload"))
    path = f"{scratch_folder(spark, 'log')}/log"
    log.repartitionByRange("lsn").sortWithinPartitions("lsn").write.json(path)
    sink, state = messages.FileSink(scratch_folder(spark, "wal-added"), "parquet", None), State()
    run = LogRun(spark, [base.event_stream()], state, sink, {"path": path, "segment_rows": str(middle // 2 + 1), "segments_per_batch": "1"}, _UNTIL_DRAINED)
    run.run()
    rows = sink.frame(run.streams[0]).select("event_id", "user_id", "score", F.lit("score" in sink.announced["public-events"]["schema"]["properties"]).alias("announced"))
    return rows.withColumn("since", F.lit(state.value["schemas"]["public-events"][0]["from"]).cast("long"))


def jdbc_splits(spark, sf_dir):
    """Line items by a key of which a quarter is one value and a seventh null, cut into twenty parts by its statistics: how many rows each part has of all, each row in one."""
    key = F.when(F.col("l_linenumber") == 1, 7).when(F.col("l_linenumber") != 3, F.col("l_orderkey"))
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(key.alias("k"), "l_orderkey", "l_linenumber")
    found = splits.predicates("k", splits.statistics(rows, "k"), 20, "l_orderkey * 7 + l_linenumber")
    inside = rows.select(F.array(*(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in found)).alias("parts"))
    sums = inside.agg(F.count("*").alias("n"), F.min(F.aggregate("parts", F.lit(0), lambda a, x: a + x)).alias("least"), F.max(F.aggregate("parts", F.lit(0), lambda a, x: a + x)).alias("most"), *(F.sum(F.col("parts")[i]).alias(f"p{i}") for i in range(len(found))))
    return sums.select("n", ((F.col("least") == 1) & (F.col("most") == 1)).alias("once"), (F.greatest(*(f"p{i}" for i in range(len(found)))) <= F.col("n") * 2 / 20).alias("even"))


def bootstrap_resumed(spark, sf_dir):
    """A snapshot of line items in parts that is broken off after the third and goes on: the rows of one snapshot."""
    tables = base._tables(spark, sf_dir)
    spec = replace(of_frame("public", "orders", tables._read("orders"), None, ("o_orderkey",)), method=LOG_BASED)
    folder, state = scratch_folder(spark, "chunks"), State()
    settings = Settings(url=_URL, auto_bootstrap_log_based=True, bootstrap_chunks=8, replication_idle_exit_seconds=0)
    sink = messages.FileSink(folder, "parquet", None)
    options = {"path": _log_folder(spark, sf_dir)}

    class Broken(Exception):
        pass

    def until_third(value):
        if value["bootstrap"].get("public-orders", {}).get("done") == 3:
            raise Broken

    first = Engine(spark, settings, tables, state, Catalog([spec]).to_dict())
    state.save = lambda: until_third(state.value)
    try:
        first.sync_log(sink, options)
    except Broken:
        state = _again(state)
    Engine(spark, settings, tables, state, Catalog([spec]).to_dict()).sync_log(sink, options)
    rows = spark.read.parquet(f"{folder}/public-orders")
    return rows.drop("_chunk", "_sdc_deleted_at", "_sdc_lsn").withColumn("bookmark", F.lit(state.bookmark("public-orders")).cast("long"))


_MAPS = {
    "public-events": {"user_id": "user_id + 1", "label": "upper(event_type)", "event_type": None, "__filter__": "value > 50 OR _sdc_deleted_at IS NOT NULL"},
    "public-users": {"__source__": "public-events", "user_id": "user_id", "n": "length(event_type)", "__key_properties__": ["user_id"], "__else__": None, "__filter__": "user_id IS NOT NULL"},
}


def wal_stream_maps(spark, sf_dir):
    """The log's rows as the settings' maps make them: one stream filtered and changed, and another made of it."""
    sink = messages.FileSink(scratch_folder(spark, "wal-maps"), "parquet", None)
    run = LogRun(spark, [base.event_stream()], State(), sink, {"path": _log_folder(spark, sf_dir)}, Settings(url=_URL, stream_maps=_MAPS, replication_idle_exit_seconds=0), now=F.lit(base.NOW))
    run.run()
    events, users = (sink.frame(s) for s in run.maps.specs(spark, run.streams))
    first = events.select(F.lit("events").alias("stream"), "event_id", "user_id", "label", F.lit(None).cast("int").alias("n"), "_sdc_deleted_at", "_sdc_lsn")
    return first.unionByName(users.select(F.lit("users").alias("stream"), F.lit(None).cast("long").alias("event_id"), "user_id", F.lit(None).cast("string").alias("label"), "n", "_sdc_deleted_at", "_sdc_lsn"))


def wal_message_order(spark, sf_dir):
    """All schemas once and before any row, quiet streams too; the second call of a run adds nothing."""
    sink, specs = messages.FrameSink(), [base.event_stream(t) for t in ("events", "clicks", "quiet")]
    run = LogRun(spark, specs, State(), sink, {"path": _log_folder(spark, sf_dir, two_tables=True)}, now=F.lit(base.NOW))
    run.run()
    run.run()
    return spark.createDataFrame([(i, kind, stream) for i, (kind, stream) in enumerate(sink.events)], "pos int, kind string, stream string")


def wal_lsn_order(spark, sf_dir):
    """Rows of a batch are in the log's order from file to file, by their numbers, whatever order the messages came in."""
    sink = messages.FileSink(scratch_folder(spark, "wal-order"), "parquet", None)
    log = base.event_log(spark, sf_dir).select("lsn", "payload").repartition(3, F.hash("lsn"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        LogRun(spark, [base.event_stream()], State(), sink, {}, now=F.lit(base.NOW)).batch(log)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    part = sink.committed()[0]["part"]
    rows = spark.read.parquet(f"{sink.folder}/_log/{part}").select(F.get_json_object("value", "$._sdc_lsn").cast("long").alias("lsn"), F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("at"))
    before = F.lag("lsn").over(Window.orderBy("file", "at"))
    return rows.withColumn("before", before).agg(F.count("*").alias("n"), F.count(F.when(F.col("before") > F.col("lsn"), 1)).alias("out_of_order"), (F.countDistinct("file") > 1).alias("several"))


def wal_state_messages(spark, sf_dir):
    """A state after each batch, each with the bookmark of what was written until then."""
    sink, run_state = messages.FrameSink(), State()
    run = LogRun(spark, [base.event_stream()], run_state, sink, {}, now=F.lit(base.NOW))
    log = base.event_log(spark, sf_dir).filter("event_type != 'error'").select("lsn", "payload")
    for i in range(4):
        run.batch(log.filter(F.pmod("lsn", F.lit(4)) == i), i)
    states = [s["bookmarks"]["public-events"]["replication_key_value"] for s in sink.states]
    return spark.createDataFrame([(i, v) for i, v in enumerate(states)], "batch int, bookmark long")


def wal_separate_readers(spark, sf_dir):
    """Each stream by a reader of its own, and all by one: the same rows."""
    specs = [replace(base.event_stream(t), method=LOG_BASED) for t in ("events", "clicks")]
    catalog, rows = Catalog(specs).to_dict(), []
    for shared in (True, False):
        engine = Engine(spark, Settings(url=_URL, log_based_single_connection=shared, replication_idle_exit_seconds=0), None, State(), catalog)
        path = _log_folder(spark, sf_dir, two_tables=True)
        report = engine.sync_log(messages.FrameSink(), {"path": path})
        rows += [(shared, s, n, report.advanced_to) for s, n in report.by_stream.items()]
    return spark.createDataFrame(rows, "shared boolean, stream string, n long, advanced_to long")


def _typed_log(spark, sf_dir, name: str, kind: str, value) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    cells = F.array(base._cell("event_id", "bigint", F.col("event_id")), base._cell(name, kind, value))
    payload = F.to_json(F.struct(F.lit("I").alias("action"), F.lit("public").alias("schema"), F.lit("typed").alias("table"), cells.alias("columns")))
    return e.select(F.col("event_id").alias("lsn"), payload.alias("payload"))


def _typed_stream(name: str, kind: T.DataType) -> StreamSpec:
    types = {"event_id": T.LongType(), name: kind}
    return StreamSpec("public", "typed", {c: base.json_schema(k) for c, k in types.items()}, ("event_id",), (), LOG_BASED, types=types).as_log_based()


def wal_timestamptz(spark, sf_dir):
    """Times with an offset are moments: typed by the database's type, and as their text where a bare catalog tells no more than date-time."""
    text = F.concat(F.date_format(F.lit("2024-03-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("event_id").cast("int")), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+02"))
    log, spec = _typed_log(spark, sf_dir, "at", "timestamp with time zone", text), _typed_stream("at", T.TimestampType())
    bare = replace(spec, types={})
    found = base.dispatched(log, Routes([spec]))
    made = base.rows_of(base.emitted(found, spec), spec, F.lit(base.NOW)).select("event_id", F.unix_micros("at").alias("micros"))
    return made.join(base.rows_of(base.emitted(found, bare), bare, F.lit(base.NOW)).select("event_id", F.col("at").alias("text")), "event_id")


def wal_uncastable_quarantined(spark, sf_dir):
    """Numbers that no column holds: their rows are set aside with the payload, the others are written."""
    number = F.when(F.col("event_id") % 5 == 0, "99999999999999999999").otherwise(F.col("user_id").cast("string"))
    sink = messages.FileSink(scratch_folder(spark, "wal-lost"), "parquet", None)
    LogRun(spark, [_typed_stream("n", T.LongType())], State(), sink, {}, now=F.lit(base.NOW)).batch(_typed_log(spark, sf_dir, "n", "bigint", number))
    bad = spark.read.parquet(sink.quarantine).select("lsn", "reason", F.get_json_object("payload", "$.columns[1].value").alias("value"))
    good = sink.frame(_typed_stream("n", T.LongType())).select(F.col("event_id").alias("lsn"), F.lit(None).cast("string").alias("reason"), F.col("n").cast("string").alias("value"))
    return bad.unionByName(good)


def wal_nested_array(spark, sf_dir):
    """Arrays in arrays keep their inner literals whole."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    literal = F.concat(F.lit("{{"), F.col("event_type"), F.lit(',"a,}"},{NULL,{'), F.col("user_id").cast("string"), F.lit("}},x}"))
    return e.select("event_id", F.array_join(array_items(literal), "|", "<null>").alias("items"))


def wal_numeric_exact(spark, sf_dir):
    """Numbers of a bare catalog keep all their digits."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = F.concat(F.lit("12345678901234567890."), F.lpad(F.col("event_id").cast("string"), 10, "0"), F.lit("1"))
    kind = from_json_schema({"type": ["number", "null"]})
    return e.select("event_id", F.to_json(typed(text, F.lit("numeric"), kind)).alias("n"))


def record_timestamps(spark, sf_dir):
    """Times in messages have microseconds."""
    df = base._read(spark, sf_dir, "events", ["event_id", "ts"]).withColumn("ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.000001).cast("decimal(18,6)")))
    lines = messages.record_lines(df, "public-events")
    return lines.select(F.get_json_object("value", "$.record.event_id").cast("long").alias("event_id"), F.substring(F.get_json_object("value", "$.record.ts"), 1, 26).alias("ts"))


def incremental_two_runs(spark, sf_dir):
    """Two runs by a time key: the second starts at the bookmark that the first has left in the state."""
    tables, state = base._tables(spark, sf_dir), State()
    df = tables._read("events")
    spec = replace(of_frame("public", "events", df, None, ("event_id",)), method=INCREMENTAL, replication_key="ts")
    catalog, out = Catalog([spec]).to_dict(), []
    for n, where in enumerate((["ts < TIMESTAMP '2024-01-15'"], []), 1):
        engine = Engine(spark, Settings(url=_URL, stream_options={"public-events": {"custom_where_clauses": where}}), tables, state, catalog)
        sink = messages.FrameSink()
        engine.sync_tables(sink)
        out.append(sink.frames["public-events"][0].select(F.lit(n).alias("run"), "event_id", "ts"))
        state = _again(state)
    return out[0].union(out[1])


def now_utc(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", utc_second(F.col("ts")).alias("now"))


def catalog_precedence(spark, sf_dir):
    """A given catalog is taken before discovery, and each stream by its method: table columns, or change-log columns too; only selected ones run."""
    found = base._catalog(spark, sf_dir)
    streams = [replace(found.get("public-nation"), method=LOG_BASED), replace(found.get("public-region"), deselected=frozenset({"r_name"})), replace(found.get("public-part"), selected=False)]
    rows = []
    for name, given in (("given", Catalog(streams).to_dict()), ("discovered", None)):
        catalog = Catalogs(lambda: Catalog([found.get("public-nation")]), given).get()
        rows += [(name, s.name, s.method, s.selected, ",".join(s.columns)) for s in catalog.streams if given is None or s in catalog.selected or not s.selected]
    return spark.createDataFrame(rows, "catalog string, stream string, method string, selected boolean, columns string")


def database_query(spark, sf_dir):
    """What is sent to a database: selected columns, quoted names, each predicate apart."""
    spec = base._catalog(spark, sf_dir).get("public-region")
    tables = JdbcTables(spark, Connection("h", 1, "d", "u", "p"))
    odd = StreamSpec('s"x', "t", {"a b": {"type": "string"}})
    rows = [("plain", tables.query(spec)), ("where", tables.query(replace(spec, deselected=frozenset({"r_name"})), ["r_regionkey % 2 = 0", "a OR b"])), ("quoted", tables.query(odd))]
    return spark.createDataFrame(rows, "kind string, query string")


_FOUND = [
    wal_source_run, wal_idle_run, wal_retried_batch, wal_run_ends, wal_message_order, wal_lsn_order, wal_state_messages, wal_separate_readers, wal_interleaved_transactions, wal_time_budget, wal_set_null, wal_unchanged_columns, wal_latest_rows, wal_added_column, jdbc_splits, bootstrap_resumed, wal_stream_maps, wal_timestamptz, wal_uncastable_quarantined, wal_nested_array, wal_numeric_exact, record_timestamps, incremental_two_runs,
    now_utc, catalog_precedence, database_query,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _FOUND}


def oracle_sql() -> dict[str, str]:
    rows, values, data = base._ROWS, base._values, base._DATA
    middle = "(SELECT max(event_id) // 2 FROM events)"
    return {
        "wal_source_run": f"SELECT * FROM {rows} UNION ALL SELECT * FROM {rows} WHERE _sdc_lsn = {middle}",
        "wal_idle_run": f"SELECT count(*) FILTER (WHERE {data}) AS n, count(*) FILTER (WHERE {data}) AS positions, count(*) FILTER (WHERE {data}) AS emitted, true AS caught_up, max(event_id) AS advanced_to FROM events",
        "wal_retried_batch": f"SELECT * FROM {rows}",
        "wal_run_ends": f"""SELECT 'drained' AS run, true AS caught_up, max(event_id) AS advanced_to, max(event_id) AS confirmed, max(event_id) AS bookmark FROM events
            UNION ALL SELECT 'out of time', false, max(event_id), max(event_id), max(event_id) FROM events WHERE event_id <= {middle}
            UNION ALL SELECT 'unheard', true, NULL, NULL, max(event_id) FROM events WHERE {data} UNION ALL SELECT 'quiet', true, max(event_id), max(event_id), max(event_id) FROM events""",
        "wal_message_order": "SELECT * FROM (VALUES (0, 'SCHEMA', 'public-events'), (1, 'SCHEMA', 'public-clicks'), (2, 'SCHEMA', 'public-quiet'), (3, 'RECORD', 'public-events'), (4, 'RECORD', 'public-clicks')) t(pos, kind, stream)",
        "wal_lsn_order": f"SELECT count(*) AS n, 0::BIGINT AS out_of_order, true AS several FROM events WHERE {data}",
        "wal_state_messages": f"SELECT i::INTEGER AS batch, max(event_id) AS bookmark FROM range(4) r(i), events WHERE {data} AND event_id % 4 <= i GROUP BY i",
        "wal_separate_readers": f"SELECT shared, {base._STREAM} AS stream, count(*) AS n, (SELECT max(event_id) FROM events) AS advanced_to FROM events, (VALUES (true), (false)) m(shared) WHERE {data} GROUP BY 1, 2",
        "wal_interleaved_transactions": f"SELECT * REPLACE (_sdc_lsn * 10 AS _sdc_lsn) FROM {rows}",
        "wal_time_budget": f"SELECT count(*) FILTER (WHERE {data}) AS n, count(*) FILTER (WHERE {data}) AS positions, true AS several, true AS caught_up, max(event_id) AS bookmark FROM events",
        "wal_set_null": 'SELECT event_id, event_id % 3 <> 0 AS there, event_id % 3 <> 0 AND (event_id % 5 = 0 OR value IS NULL) AS "null" FROM events',
        "wal_unchanged_columns": """SELECT event_id, user_id, last_value(CASE WHEN event_id % 3 <> 0 THEN struct_pack(v := CASE WHEN event_id % 5 <> 0 THEN value END) END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id).v AS value, event_type FROM events""",
        "wal_latest_rows": """SELECT user_id, max(event_id) AS event_id, arg_max(CASE WHEN event_id % 3 <> 0 THEN struct_pack(v := CASE WHEN event_id % 5 <> 0 THEN value END) END, event_id).v AS value, arg_max(event_type, event_id) AS event_type FROM events GROUP BY user_id""",
        "wal_added_column": f"SELECT event_id, user_id, CASE WHEN event_id > {middle} THEN (user_id * 2)::INTEGER END AS score, true AS announced, (SELECT min(event_id) FROM events WHERE event_id > {middle}) AS since FROM events",
        "jdbc_splits": "SELECT count(*) AS n, true AS once, true AS even FROM lineitem",
        "bootstrap_resumed": "SELECT *, (SELECT max(event_id) FROM events) AS bookmark FROM orders",
        "wal_stream_maps": f"""SELECT 'events' AS stream, event_id, user_id + 1 AS user_id, upper(event_type) AS label, NULL::INTEGER AS n, _sdc_deleted_at, _sdc_lsn FROM {rows} WHERE value > 50 OR _sdc_deleted_at IS NOT NULL
            UNION ALL SELECT 'users', NULL, user_id, NULL, length(event_type)::INTEGER, _sdc_deleted_at, _sdc_lsn FROM {rows} WHERE user_id IS NOT NULL""",
        "wal_timestamptz": "SELECT event_id, epoch_us(TIMESTAMP '2024-03-01' + to_hours(event_id) - to_hours(2)) AS micros, strftime(TIMESTAMP '2024-03-01' + to_hours(event_id), '%Y-%m-%d %H:%M:%S.%f') || '+02' AS text FROM events",
        "wal_uncastable_quarantined": "SELECT event_id AS lsn, CASE WHEN event_id % 5 = 0 THEN 'uncastable: n' END AS reason, CASE WHEN event_id % 5 = 0 THEN '99999999999999999999' ELSE user_id::VARCHAR END AS value FROM events",
        "wal_nested_array": """SELECT event_id, '{' || event_type || ',"a,}"}|{NULL,{' || user_id || '}}|x' AS items FROM events""",
        "wal_numeric_exact": "SELECT event_id, '12345678901234567890.' || lpad(event_id::VARCHAR, 10, '0') || '1' AS n FROM events",
        "record_timestamps": "SELECT event_id, strftime(ts + INTERVAL 1 MICROSECOND, '%Y-%m-%dT%H:%M:%S.%f') AS ts FROM events",
        "incremental_two_runs": "SELECT 1 AS run, event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-15' UNION ALL SELECT 2, event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-15')",
        "now_utc": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS now FROM events",
        "catalog_precedence": "SELECT * FROM (VALUES ('given', 'public-nation', 'LOG_BASED', true, 'n_nationkey,n_name,n_regionkey,_sdc_deleted_at,_sdc_lsn'), ('given', 'public-region', 'FULL_TABLE', true, 'r_regionkey'), ('given', 'public-part', 'FULL_TABLE', false, (SELECT string_agg(column_name, ',' ORDER BY column_index) FROM duckdb_columns() WHERE table_name = 'part')), ('discovered', 'public-nation', 'FULL_TABLE', true, 'n_nationkey,n_name,n_regionkey')) t(catalog, stream, method, selected, columns)",
        "database_query": """SELECT * FROM (VALUES ('plain', 'SELECT "r_regionkey", "r_name" FROM "public"."region"'), ('where', 'SELECT "r_regionkey" FROM "public"."region" WHERE (r_regionkey % 2 = 0) AND (a OR b)'), ('quoted', 'SELECT "a b" FROM "s""x"."t"')) t(kind, query)""",
    }
