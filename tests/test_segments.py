"""Landing, transactions, batches that count as a whole, absent and new columns, sessions in other zones."""

import json
import random
from dataclasses import replace

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import INCREMENTAL, LOG_BASED, Settings
from tidemark.functions.types import json_schema
from tidemark.functions.values import iso_timestamp, utc_second
from tidemark.operators.images import PRESENT, filled, latest
from tidemark.operators.messages import FileSink, MessageSink
from tidemark.operators.table_stream import bootstrap, flattened, new_bookmark, read_stream
from tidemark.plans.catalog import StreamSpec, of_frame
from tidemark.sources import wal
from tidemark.sources.segments import Landing, SegmentWriter, land
from tidemark.streaming.run import LogRun
from tidemark.streaming.state import State

BEGIN, COMMIT = '{"action":"B","xid":1}', '{"action":"C","xid":1}'
URL = "postgresql://u:p@h/d"


def spec(table="users", **kinds):
    kinds = kinds or {"id": T.LongType(), "name": T.StringType()}
    return StreamSpec("public", table, {c: json_schema(k) for c, k in kinds.items()}, ("id",), (), LOG_BASED, types=kinds).as_log_based()


def change(action="I", table="users", **values):
    cells = [{"name": k, "type": "text" if isinstance(v, str) else "bigint", "value": v} for k, v in values.items()]
    return json.dumps({"action": action, "schema": "public", "table": table, "identity" if action == "D" else "columns": cells})


def transactions(*each):
    """Lines of transactions: ``(commit, positions)``, as a slot sends them."""
    out = []
    for commit, lsns in each:
        out += [(min(lsns, default=commit), BEGIN), *((n, change(id=n)) for n in lsns), (commit, COMMIT)]
    return out


class Log:
    """A log in memory, told and asked like a client; ``fails`` says before which line the connection breaks."""

    def __init__(self, lines, end, fails=None):
        self.lines, self.end, self.fails, self.told, self.wal_end = lines, end, fails, [], None

    def tip(self):
        return self.end

    def follow(self, start):
        for i, line in enumerate(self.lines):
            if i == self.fails:
                raise OSError("lost")
            yield line
        self.wal_end = self.end
        yield None

    def feedback(self, lsn):
        self.told.append(lsn)


def writer(folder, start=0, **more):
    landing = Landing(str(folder))
    last = landing.last()
    return SegmentWriter(landing, last.number + 1 if last else 0, start, last.last if last else -1, "x", last.at_last if last else 0, **more)


def landed(folder):
    landing = Landing(str(folder))
    out = []
    for s in landing.segments():
        for f in s.files:
            rows = pq.read_table(f"{folder}/files/{f['path']}").to_pylist()
            out += [(r["lsn"], f["commit"] or r["commit"], r["seq"]) for r in rows]
    return out


def test_transactions_that_overlap_keep_their_order(tmp_path):
    lines = transactions((200, [150, 160]), (300, [100, 170, 250]), (310, []), (400, [305]))
    log = Log(lines, 400)
    got = land(log, writer(tmp_path, most_rows=2), 400, 60, 60)
    assert got.drained and got.rows == 6 and log.told[-1] == 400
    want = [(150, 200, 0), (160, 200, 1), (100, 300, 0), (170, 300, 1), (250, 300, 2), (305, 400, 0)]
    assert landed(tmp_path) == want and [s.last for s in Landing(str(tmp_path)).segments()] == [200, 300, 400]
    # The same log again gives nothing, and a longer one what is new.
    assert land(Log(lines, 400), writer(tmp_path), 400, 60, 60).rows == 0
    assert land(Log(lines + transactions((500, [350, 450])), 500), writer(tmp_path), 500, 60, 60).rows == 2
    assert landed(tmp_path) == [*want, (350, 500, 0), (450, 500, 1)]


@pytest.mark.parametrize("fails", range(0, 22))
def test_a_connection_that_breaks_loses_nothing(tmp_path, fails):
    lines = transactions((200, [150, 160]), (300, [100, 170, 250]), (400, [305, 310, 315, 320, 325]), (500, [130, 410]))
    with pytest.raises(OSError) if fails < len(lines) else pytest.MonkeyPatch.context():
        land(Log(lines, 500, fails), writer(tmp_path, most_rows=2, file_chars=150), 500, 60, 60)
    land(Log(lines, 500), writer(tmp_path, most_rows=2, file_chars=150), 500, 60, 60)
    assert sorted(landed(tmp_path)) == sorted([(150, 200, 0), (160, 200, 1), (100, 300, 0), (170, 300, 1), (250, 300, 2), *((305 + 5 * i, 400, i) for i in range(5)), (130, 500, 0), (410, 500, 1)])


def test_a_large_transaction_is_written_as_it_comes(tmp_path):
    w = writer(tmp_path, most_rows=3, file_chars=400)
    held = []
    for lsn, payload in transactions((5000, list(range(100, 400)))):
        w.add(lsn, payload)
        held.append(len(w._held["lsn"]))
    assert max(held) < 12 and w.publish()
    files = Landing(str(tmp_path)).segments()[0].files
    assert len(files) > 20 and landed(tmp_path) == [(100 + i, 5000, i) for i in range(300)]
    # One that never commits leaves nothing.
    for lsn, payload in transactions((6000, list(range(5100, 5400))))[:-1]:
        w.add(lsn, payload)
    w._abandon()
    assert len(list((tmp_path / "files").iterdir())) == len(files) and not w.publish()


def test_messages_without_frames_go_on_where_they_were(tmp_path):
    lines = [(n, change(id=n)) for n in (5, 7, 7, 7, 9)]
    assert land(Log(lines, 9), writer(tmp_path, start=6, most_rows=2), 9, 60, 60, most=1).rows == 2
    assert land(Log(lines, 9), writer(tmp_path, start=6, most_rows=2), 9, 60, 60).rows == 2
    assert landed(tmp_path) == [(7, None, None)] * 3 + [(9, None, None)]


def test_time_and_silence(tmp_path):
    ticks = iter(range(0, 10_000, 1))
    got = land(Log([(n, change(id=n)) for n in range(100)], 99), writer(tmp_path), 99, 20, 60, clock=lambda: next(ticks))
    assert 0 < got.rows < 40 and not got.drained
    got = land(Log([(n, change(id=n)) for n in range(100)], 99), writer(tmp_path), 99, 1000, 60)
    assert got.drained and len(landed(tmp_path)) == 100
    # Silence before the log's end is no end; where the end isn't known it is.
    quiet = Log([(200, change(id=1))], 150)
    assert not land(quiet, writer(tmp_path), 300, 60, 0).drained
    assert land(Log([], None), writer(tmp_path), None, 60, 0).drained


def test_calls_with_little_time_get_behind_what_is_landed(tmp_path):
    lines = [(n, change(id=n)) for n in range(200)]
    for calls in range(1, 100):
        ticks = iter(range(0, 10_000, 1))
        got = land(Log(lines, 199), writer(tmp_path), 199, 20, 60, clock=lambda: next(ticks))
        assert got.rows or got.drained
        if got.drained:
            break
    assert 3 < calls < 99 and [r[0] for r in landed(tmp_path)] == list(range(200))


@pytest.mark.parametrize("framed", [False, True])
def test_blocks_of_a_log_are_its_messages(tmp_path, monkeypatch, framed):
    """Landed by blocks and read on from marks, by processes that only know what a file says of the log."""
    monkeypatch.setattr(wal.DirectoryLog, "BLOCK_BYTES", 700)
    lines = transactions(*((10 * i + 9, [10 * i + k for k in (1, 3, 2)]) for i in range(40))) if framed else [(n // 3, change(id=n, t="\u00e9\n")) for n in range(120)]
    put(tmp_path / "log", "a", lines[:77])
    put(tmp_path / "log", "b", lines[77:])
    for most in range(1, 100):
        monkeypatch.setattr(wal.DirectoryLog, "_ends", {})
        client = wal.DirectoryLog({"path": str(tmp_path / "log"), "known": str(tmp_path / "known" / "k.json")})
        if land(client, writer(tmp_path / "landing", most_rows=7), client.tip(), 60, 0, most=1).drained:
            break
    want = [(n, None, None) for n, _ in lines] if not framed else [(n, c, i % 3) for i, (n, c) in enumerate((10 * i + k, 10 * i + 9) for i in range(40) for k in (1, 3, 2))]
    assert landed(tmp_path / "landing") == want and most > 5
    start = lines[-1][0]
    assert 0 < sum(b.num_rows for b in client.blocks(start) if b is not None) < 40


def test_a_refused_confirmation_is_no_failure(tmp_path):
    class Deaf(Log):
        def feedback(self, lsn):
            raise OSError("no one listens")

    assert land(Deaf(transactions((5, [1])), 5), writer(tmp_path), 5, 60, 60).rows == 1


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    with open(folder / f"{name}.jsonl", "w") as f:
        f.writelines(json.dumps({"lsn": n, "payload": p}) + "\n" for n, p in lines)


def random_transactions(rng, n):
    """Overlapping transactions of two tables, in the order of their commits."""
    at, open_, done = 0, [], []
    for _ in range(n):
        at += 1
        if not open_ or rng.random() < 0.1:
            open_.append([])
        rng.choice(open_).append(at)
        if rng.random() < 0.12:
            at += 1
            done.append((at, open_.pop(rng.randrange(len(open_)))))
    for t in open_:
        at += 1
        done.append((at, t))
    return done


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_over_growing_logs_give_each_row_once(spark, tmp_path, seed):
    rng = random.Random(seed)
    done = random_transactions(rng, 400)
    cuts = sorted(rng.sample(range(1, len(done)), 2)) + [len(done)]
    sink, state = FileSink(str(tmp_path / "out"), "parquet", None), State()
    begun = 0
    for i, cut in enumerate(cuts):
        put(tmp_path / "log", f"part{i}", transactions(*done[begun:cut]))
        begun = cut
        options = {"path": str(tmp_path / "log"), "segment_rows": "50", "file_chars": "300", "segments_per_batch": "2"}
        report = LogRun(spark, [spec()], state, sink, options).run()
        assert report.caught_up and state.bookmark("public-users") == done[cut - 1][0]
        state = State(value=json.loads(json.dumps(state.value)))
    rows = [r["id"] for r in sink.frame(spec()).collect()]
    assert sorted(rows) == sorted(n for _, lsns in done for n in lsns)


def test_the_source_gives_transactions_to_their_commits_batch(spark, tmp_path):
    put(tmp_path / "log", "a", transactions((200, [150]), (300, [100, 250])))
    wal.register(spark)
    got = {}
    for n, (start, end) in enumerate(((0, 201), (201, 301))):
        stream = spark.readStream.format(wal.FORMAT).options(path=str(tmp_path / "log"), start_lsn=start, end_lsn=end, feedback="false").load()
        query = stream.writeStream.format("memory").queryName(f"part{n}_{tmp_path.name.replace('-', '_')}").trigger(availableNow=True).start()
        query.awaitTermination()
        got[n] = sorted(tuple(r)[:1] + tuple(r)[2:] for r in spark.table(query.name).collect())
    assert got == {0: [(150, 200, 0)], 1: [(100, 300, 0), (250, 300, 1)]}


class Killed(FileSink):
    """Dies before a batch counts."""

    alive = False

    def commit(self, part, entry):
        if not self.alive:
            raise KeyboardInterrupt
        super().commit(part, entry)


def test_a_batch_counts_as_a_whole(spark, tmp_path):
    put(tmp_path / "log", "a", [(n, change(table=f"t{n % 2}", id=n)) for n in range(1, 9)])
    specs = [spec("t0"), spec("t1")]
    options, landing = {"path": str(tmp_path / "log")}, str(tmp_path / "landing")
    sink = Killed(str(tmp_path / "out"))
    with pytest.raises(KeyboardInterrupt):
        LogRun(spark, specs, State(), sink, options, landing=landing).run()
    assert list((tmp_path / "out/_log").rglob("part-*")) and all(sink.frame(s).count() == 0 for s in specs)
    sink.alive = True
    LogRun(spark, specs, State(), sink, options, landing=landing).run()
    assert [sink.frame(s).count() for s in specs] == [4, 4]


def test_what_the_sink_holds_is_not_written_again(spark, tmp_path):
    """A run that is lost between its commit and its state goes on behind the commit."""
    put(tmp_path / "log", "a", transactions((10, [1, 2]), (20, [3])))
    options, landing = {"path": str(tmp_path / "log")}, str(tmp_path / "landing")
    sink = FileSink(str(tmp_path / "out"))
    LogRun(spark, [spec()], State(), sink, options, landing=landing).run()
    state = State()
    LogRun(spark, [spec()], state, FileSink(str(tmp_path / "out")), options, landing=landing).run()
    assert sink.frame(spec()).count() == 3 and state.bookmark("public-users") == 20


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"count-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(tracker.getJobIdsForGroup(group))


def test_jobs_of_a_batch_do_not_grow_with_streams(spark, tmp_path):
    counts = []
    for n in (5, 200):
        specs = [spec(f"t{i}") for i in range(n)]
        log = spark.createDataFrame([(k, change(table=f"t{k % n}", id=k, name=f"n{k}")) for k in range(400)], "lsn long, payload string")
        sink = FileSink(str(tmp_path / f"out{n}"), "parquet", None)
        run = LogRun(spark, specs, State(), sink, {})
        sink.schemas(specs)
        counts.append(jobs_of(spark, lambda: run.batch(log)))  # noqa: B023
        assert sorted(r["id"] for r in sink.frame(specs[3]).collect()) == list(range(3, 400, n))
    assert 0 < counts[1] <= counts[0] + 1


def test_absent_null_and_unknown_values(spark, tmp_path):
    s = spec(id=T.LongType(), name=T.StringType(), big=T.StringType(), n=T.DecimalType(10, 2), at=T.TimestampNTZType(), tags=T.ArrayType(T.StringType()), doc=T.VariantType())
    full = {"action": "U", "schema": "public", "table": "users", "columns": [{"name": k, "type": t, "value": v} for k, t, v in (("id", "bigint", 1), ("name", "text", 'a "b"\n'), ("big", "text", None), ("n", "numeric(10,2)", "1.50"), ("at", "timestamp", "2024-03-10 02:30:00.000001"), ("tags", "text[]", '{x,"y z"}'), ("doc", "jsonb", '{"k":[1]}'))]}
    rows = [(1, json.dumps(full)), (2, change("U", id=1, name="c")), (3, change("D", id=1)), (4, change("U", id=1, other=5, name="x"))]
    twice = '{"action":"U","schema":"public","table":"users","columns":[{"name":"id","type":"bigint","value":7},{"name":"id","type":"bigint","value":8}]}'
    sink = FileSink(str(tmp_path / "out"))
    settings = Settings.of({"url": URL, "evolve_schemas": False})
    run = LogRun(spark, [s], State(), sink, {}, settings, now=F.lit("now"))
    run.batch(spark.createDataFrame([*rows, (5, twice)], "lsn long, payload string"))
    lines = {json.loads(r[0])["_sdc_lsn"]: json.loads(r[0]) for r in spark.read.text(f"{sink.folder}/_log/{sink.committed()[0]['part']}").select("value").collect()}
    assert lines[1] == {"id": 1, "name": 'a "b"\n', "big": None, "n": 1.5, "at": "2024-03-10T02:30:00.000001", "tags": ["x", "y z"], "doc": {"k": [1]}, "_sdc_deleted_at": None, "_sdc_lsn": 1}
    assert lines[2] == {"id": 1, "name": "c", "_sdc_deleted_at": None, "_sdc_lsn": 2} and lines[3] == {"id": 1, "_sdc_deleted_at": "now", "_sdc_lsn": 3}
    assert lines[4] == {"id": 1, "name": "x", "_sdc_deleted_at": None, "_sdc_lsn": 4} and lines[5]["id"] == 8
    assert run.report.counts == {"emitted": 5, "unknown_column": 1} and [r["lsn"] for r in spark.read.parquet(sink.quarantine).collect()] == [4]
    typed = {r["_sdc_lsn"]: r for r in sink.frame(s, presence=True).collect()}
    assert str(typed[1]["n"]) == "1.50" and typed[1]["at"].microsecond == 1 and typed[1][PRESENT] == ["id", "name", "big", "n", "at", "tags", "doc"] and typed[2][PRESENT] == ["id", "name"]


def test_messages_have_the_columns_of_their_changes(spark):
    lines = []
    sink = MessageSink(lines.append)
    run = LogRun(spark, [spec()], State(), sink, {})
    run.batch(spark.createDataFrame([(2, change("U", id=1)), (1, change("I", id=1, name="a")), (3, change("U", id=1, name="b", more="x"))], "lsn long, payload string"))
    got = [json.loads(x) for x in lines]
    assert [m["type"] for m in got] == ["SCHEMA", "RECORD", "RECORD", "RECORD", "STATE"] and "more" in got[0]["schema"]["properties"]
    assert [m["record"] for m in got[1:4]] == [{"id": 1, "name": "a", "_sdc_deleted_at": None, "_sdc_lsn": 1}, {"id": 1, "_sdc_deleted_at": None, "_sdc_lsn": 2}, {"id": 1, "name": "b", "more": "x", "_sdc_deleted_at": None, "_sdc_lsn": 3}]
    run.batch(spark.createDataFrame([(4, change("U", id=1, later=7))], "lsn long, payload string"), 1)
    assert [json.loads(x)["type"] for x in lines[5:]] == ["SCHEMA", "RECORD", "STATE"]
    # The next run knows them from the state.
    again = LogRun(spark, [spec()], State(value=json.loads(json.dumps(run.state.value))), MessageSink(lines.append), {})
    assert [c for c in again.streams[0].properties] == ["id", "name", "more", "later", "_sdc_deleted_at", "_sdc_lsn"] and again.streams[0].type_of("later") == T.LongType()


def test_deselected_columns_are_not_new(spark, tmp_path):
    s = replace(spec(), deselected=frozenset({"name"}))
    run = LogRun(spark, [s], State(), FileSink(str(tmp_path / "out")), {})
    run.batch(spark.createDataFrame([(1, change(id=1, name="a"))], "lsn long, payload string"))
    assert "schemas" not in run.state.value and run.sink.frame(s).columns == ["id", "_sdc_deleted_at", "_sdc_lsn"]


def images(rng, n, keys):
    rows, have = [], {}
    for i in range(n):
        k = 0 if rng.random() < 0.6 else rng.choice(keys)
        deleted = rng.random() < 0.05
        cols = [] if deleted else [c for c in ("a", "b") if rng.random() < 0.5]
        values = {c: None if rng.random() < 0.3 else f"{c}{i}" for c in cols}
        have.setdefault(k, {}).update(values)
        rows.append((k, values.get("a"), values.get("b"), "gone" if deleted else None, i, ["k", *cols], dict(have[k])))
    return rows


def test_filled_and_latest_by_loops(spark, tmp_path):
    rng = random.Random(8)
    rows = images(rng, 600, [None, 1, 2, 3, 4, 5])
    df = spark.createDataFrame([r[:6] for r in rows], f"k long, a string, b string, _sdc_deleted_at string, _sdc_lsn long, {PRESENT} array<string>").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["_sdc_lsn"]: (r["k"], r["a"], r["b"]) for r in filled(df, ["k"], ["a", "b"], str(tmp_path / "images")).collect()}
        several = spark.read.parquet(str(tmp_path / "images")).filter("k = 0").select("_range").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert several > 1 and got == {r[4]: (r[0], r[6].get("a"), r[6].get("b")) for r in rows}
    state = {}
    for k, a, b, gone, _, cols, _ in rows:
        if gone:
            state[k] = None
        else:
            state[k] = (state.get(k) or {}) | {c: v for c, v in (("a", a), ("b", b)) if c in cols}
    want = {(k, v.get("a"), v.get("b")) for k, v in state.items() if v is not None}
    assert {tuple(r) for r in latest(df, ["k"], ["a", "b"]).collect()} == want


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_utc_in_any_session(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = spark.sql("SELECT TIMESTAMP '2024-03-10 07:30:00.25 UTC' AS z, TIMESTAMP_NTZ '2024-03-10 02:30:00' AS n, timestamp_micros(0) AS e").select(utc_second(F.col("z")), iso_timestamp(F.col("z")), utc_second(F.col("n")), iso_timestamp(F.col("n")), iso_timestamp(F.col("e"))).first()
        now = spark.range(1).select(utc_second(F.current_timestamp()).alias("a"), F.unix_seconds(F.current_timestamp()).alias("b")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(got) == ("2024-03-10T07:30:00Z", "2024-03-10T07:30:00.250000+00:00", "2024-03-10T02:30:00Z", "2024-03-10T02:30:00.000000+00:00", "1970-01-01T00:00:00.000000+00:00")
    from datetime import datetime, timezone

    assert now["a"] == datetime.fromtimestamp(now["b"], timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def test_column_names_with_dots(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", 3), (2, "y", None)], "`a.b` long, `c``d` string, `e.f` long")
    s = StreamSpec(**{**of_frame("public", "t", df).__dict__, "method": INCREMENTAL, "replication_key": "e.f", "keys": ("a.b",)})
    assert [tuple(r) for r in read_stream(df, s, None, 2).collect()] == [(1, "x", 3)] and new_bookmark(df, "e.f").first()[0] == 3
    assert bootstrap(df, s.as_log_based()).columns == ["a.b", "c`d", "e.f", "_sdc_deleted_at", "_sdc_lsn"]
    lines = []
    MessageSink(lines.append).rows(s, df)
    assert json.loads(lines[1])["record"] == {"a.b": 1, "c`d": "x", "e.f": 3}
    sink = FileSink(str(tmp_path / "out"), compression=None)
    sink.rows(s, df)
    assert '"e.f":null' in "".join(r[0] for r in spark.read.text(f"{sink.folder}/public-t").collect())
    with pytest.raises(ValueError, match="s__a"):
        flattened(spark.sql("SELECT named_struct('a', 1) AS s, 2 AS s__a"))
