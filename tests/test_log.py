import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LOG_BASED, Settings
from tidemark.functions.identifiers import escape, table_filter
from tidemark.functions.lsn import format_lsn, parse_lsn
from tidemark.functions.types import json_schema
from tidemark.functions.values import array_items, hstore, typed
from tidemark.operators.decode import rows_of
from tidemark.operators.dispatch import Routes, counters, counts_by_stream, dispatched, emitted, max_lsn_seen, quarantined
from tidemark.operators.messages import FrameSink
from tidemark.plans.catalog import StreamSpec
from tidemark.sources import wal
from tidemark.streaming.run import Engine, LogRun
from tidemark.streaming.state import State, advance_to, current_tip, forward


def spec(table="users", **kinds):
    kinds = kinds or {"id": T.LongType(), "name": T.StringType()}
    return StreamSpec("public", table, {c: json_schema(k) for c, k in kinds.items()}, ("id",), (), LOG_BASED, types=kinds).as_log_based()


def message(action, table="users", schema="public", **values):
    cells = [{"name": k, "type": t, "value": v} for k, (t, v) in values.items()]
    return json.dumps({"action": action, "schema": schema, "table": table} | ({"identity": cells} if action == "D" else {"columns": cells} if cells else {}))


def log(spark, *rows):
    return spark.createDataFrame(list(rows), "lsn long, payload string")


def read(spark, s, *rows, routes=None, **more):
    return rows_of(emitted(dispatched(log(spark, *rows), routes or Routes([s])), s), s, F.lit("now"), **more)


@pytest.mark.parametrize("action", ["I", "U"])
def test_upsert(spark, action):
    got = read(spark, spec(), (12345, message(action, id=("integer", 42), name=("text", "alice")))).first()
    assert got.asDict() == {"id": 42, "name": "alice", "_sdc_deleted_at": None, "_sdc_lsn": 12345}


def test_delete_has_identity_only(spark):
    got = read(spark, spec(), (55, message("D", id=("integer", 5))), carry_present=True).first()
    assert (got["id"], got["name"], got["_sdc_deleted_at"], got["_sdc_lsn"], got["_present_cols"]) == (5, None, "now", 55, ["id"])


def test_no_rows(spark):
    rows = [(i, message(a, id=("integer", 1))) for i, a in enumerate("TBCX")]
    found = dispatched(log(spark, *rows), Routes([spec()]))
    assert [r["disposition"] for r in found.orderBy("lsn").collect()] == ["truncate", "transaction", "transaction", "unknown"]
    assert emitted(found, spec()).isEmpty() and quarantined(found).count() == 1


@pytest.mark.parametrize("kind", ["integer", "numeric(10,2)", "bigint", "double precision"])
def test_empty_numbers_are_null(spark, kind):
    assert read(spark, spec(), (1, message("I", id=(kind, ""), name=("text", "")))).first()[:2] == (None, "")


def test_broken_payloads(spark):
    bad = '{"action":"I","schema":"public","table":"users","columns":[{"name":"name","type":""MyEnum"","value":"X"}]}'
    odd = message("I", name=("text", '"type":""X""'))
    found = dispatched(log(spark, (1, bad), (2, "{not json{"), (3, "[]"), (4, "7"), (5, None), (6, odd), (7, message("I"))), Routes([spec()]))
    rows = {r["lsn"]: r for r in found.collect()}
    assert rows[1]["msg"]["columns"][0]["type"] == "MyEnum" and rows[6]["msg"]["columns"][0]["value"] == '"type":""X""'
    assert {k: r["disposition"] for k, r in rows.items()} == {1: "upsert", 2: "malformed", 3: "malformed", 4: "malformed", 5: "malformed", 6: "upsert", 7: "quarantined"}
    assert max_lsn_seen(found).first()[0] == 7


def test_last_of_equal_names_and_missing_columns(spark):
    twice = '{"action":"U","schema":"public","table":"users","columns":[{"name":"id","type":"integer","value":1},{"name":"id","type":"integer","value":2}]}'
    got = read(spark, spec(), (1, twice), carry_present=True).first()
    assert got["id"] == 2 and got["name"] is None and got["_present_cols"] == ["id", "id"]


@pytest.mark.parametrize("text, want", [("{}", []), ('{1,2}', ["1", "2"]), ('{"This is a \\"test\\"",2}', ['This is a "test"', "2"]), ('{a,NULL,"NULL",""}', ["a", None, "NULL", ""]), ('{"a,b","c\\\\d"}', ["a,b", "c\\d"]), ('["x",null]', ["x", None]), ("nonsense", None)])
def test_arrays(spark, text, want):
    assert spark.createDataFrame([(text,)], "v string").select(array_items(F.col("v"))).first()[0] == want


def test_typed_arrays_hstore_booleans(spark):
    df = spark.createDataFrame([("{1,x,NULL}", '"a"=>"1", "b"=>NULL, "a"=>"2"', "t")], "a string, h string, b string")
    got = df.select(typed(F.col("a"), F.lit("integer[]"), T.ArrayType(T.IntegerType())), hstore(F.col("h")), typed(F.col("b"), F.lit("boolean"), T.BooleanType())).first()
    assert tuple(got) == ([1, None, None], {"a": "2", "b": None}, True)


def test_routing_and_counts(spark):
    s, o, q = spec(), spec("orders"), spec("quiet")
    rows = [(10, message("I", id=("integer", 1))), (11, message("I", "orders", id=("integer", 99))), (12, message("U", id=("integer", 2))), (13, message("I", "ghosts", id=("integer", 1))), (14, '{"action":"B"}')]
    routes = Routes([s, o, q])
    found = dispatched(log(spark, *rows), routes)
    assert {r["disposition"]: r["n"] for r in counters(found).collect()} == {"emitted": 3, "unroutable": 1, "non_data": 1}
    assert {r["stream"]: r["emitted"] for r in counts_by_stream(found, routes).collect()} == {"public-users": 2, "public-orders": 1, "public-quiet": 0}
    assert [r["id"] for r in rows_of(emitted(found, o), o).collect()] == [99]


def test_equal_names_route_apart(spark):
    a, b = StreamSpec("a.b", "c", {"id": {"type": "integer"}}), StreamSpec("a", "b.c", {"id": {"type": "integer"}})
    found = dispatched(log(spark, (1, message("I", "c", "a.b", id=("integer", 1))), (2, message("I", "b.c", "a", id=("integer", 1)))), Routes([a, b]))
    assert [r["stream"] for r in found.orderBy("lsn").collect()] == [a.name, b.name] == ["a.b-c", "a-b.c"]


def test_start_of_each_stream(spark):
    a, b = spec("a"), spec("b")
    routes = Routes([a, b], {"public-a": 100, "public-b": 200})
    rows = [(150, message("I", "b", id=("integer", 1))), (250, message("I", "b", id=("integer", 2))), (120, message("I", "a", id=("integer", 3))), (100, message("I", "a", id=("integer", 4)))]
    found = dispatched(log(spark, *rows), routes)
    assert routes.global_start == 100
    assert sorted((r["stream"], r["lsn"]) for r in found.filter("disposition = 'upsert'").collect()) == [("public-a", 100), ("public-a", 120), ("public-b", 250)]


def test_registration():
    with pytest.raises(ValueError):
        Routes([])
    with pytest.raises(ValueError):
        Routes([spec(), spec()])
    with pytest.raises(ValueError):
        Routes([StreamSpec("", "t", {})])
    assert Routes([spec(), spec("x")], {"public-x": 5}).global_start == 0
    assert Routes([StreamSpec("my,schema", "tbl.name", {})]).add_tables == r"my\,schema.tbl\.name"


def test_names_and_positions():
    assert [escape(x) for x in ("a,b", "a.b", "a\\b", "a\\,b")] == ["a\\,b", "a\\.b", "a\\\\b", "a\\\\\\,b"]
    assert table_filter([("s", "t"), ("u", "v")]) == "s.t,u.v"
    assert parse_lsn("6/4A3B2C10") == (6 << 32) + 0x4A3B2C10 and format_lsn(parse_lsn("1/0")) == "1/0"
    assert wal.replication_options("x") == {"format-version": "2", "include-transaction": "False", "add-tables": "x"}


def test_advance():
    assert advance_to(10, 0, 999, True) == 999 and advance_to(10, 0, 777, False) is None
    assert advance_to(10, 40, 777, False) == 40 and advance_to(10, 50, 20, True) == 50 and advance_to(10, 0, None, True) is None and advance_to(10, 0, 10, True) is None
    assert forward(1000, 500) == 1000 and forward(None, 5) == 5 and forward(7, None) == 7
    assert current_tip(30, 10, lambda: 1) == 30 and current_tip(10, 10, lambda: 99) == 99 and current_tip(None, 0, lambda: None) is None


def test_state(tmp_path):
    s = State(str(tmp_path / "x/state.json"))
    assert s.advance("a", "_sdc_lsn", 1000) and not s.advance("a", "_sdc_lsn", 500) and not s.advance("a", "_sdc_lsn", None) and s.advance("a", "_sdc_lsn", 2000)
    s.mark_start("b", "_sdc_lsn", 7)
    s.save()
    again = State(str(tmp_path / "x/state.json"))
    assert again.bookmark("a") == 2000 and again.start("b") == 7 and again.bookmark("c") is None


def put(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    with open(folder / f"{name}.jsonl", "w") as f:
        f.writelines(json.dumps({"lsn": n, "payload": p}) + "\n" for n, p in rows)



class Rows(FrameSink):
    """Keeps rows."""

    def __init__(self):
        super().__init__()
        self.kept = {}

    def rows(self, s, df):
        self.schema(s)
        got = df.collect()
        self.kept.setdefault(s.name, []).extend(got)
        self.events += [("RECORD", s.name)] * len(got)


def test_run_resume_and_feedback(spark, tmp_path):
    folder = tmp_path / "log"
    put(folder, "a", (10, message("I", id=("integer", 1))), (11, message("I", "orders", id=("integer", 99))), (12, message("D", id=("integer", 1))), (13, "{bad"))
    state, sink = State(str(tmp_path / "state.json")), Rows()
    specs = [spec(), spec("orders")]
    more = {"landing": str(tmp_path / "land"), "quarantine": str(tmp_path / "bad")}
    run = LogRun(spark, specs, state, sink, {"path": str(folder)}, **more)
    report = run.run()
    assert report.caught_up and report.advanced_to == 13 and report.counts == {"emitted": 3, "malformed": 1}
    assert run.run() is report
    assert [r["id"] for r in sink.kept["public-users"]] == [1, 1] and state.bookmark("public-orders") == 13
    assert wal.DirectoryLog({"path": str(folder)}).acknowledged() == 13
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1 and spark.read.parquet(str(tmp_path / "land/files")).count() == 4
    assert [k for k, _ in sink.events][:2] == ["SCHEMA", "SCHEMA"]
    put(folder, "b", (20, message("I", "orders", id=("integer", 100))))
    sink = Rows()
    report = LogRun(spark, specs, State(str(tmp_path / "state.json")), sink, {"path": str(folder)}, **more).run()
    assert report.by_stream == {"public-users": 0, "public-orders": 1} and [r["id"] for r in sink.kept["public-orders"]] == [100]


def test_quiet_log_moves_to_the_tip(spark, tmp_path):
    folder = tmp_path / "log"
    put(folder, "a", (20, message("I", "other", id=("integer", 1))))
    state = State(value={"bookmarks": {"public-users": {"replication_key": "_sdc_lsn", "replication_key_value": 10}}})
    report = LogRun(spark, [spec()], state, Rows(), {"path": str(folder)}).run()
    assert report.counts == {"unroutable": 1} and state.bookmark("public-users") == 20


def test_failed_feedback_leaves_bookmarks(spark, tmp_path, monkeypatch):
    folder = tmp_path / "log"
    put(folder, "a", (20, message("I", id=("integer", 1))), (30, message("T", id=("integer", 1))))
    state = State()

    def fail(self, lsn):
        raise OSError("gone")

    monkeypatch.setattr(wal.DirectoryLog, "feedback", fail)
    report = LogRun(spark, [spec()], state, Rows(), {"path": str(folder), "feedback": "false"}).run()
    assert report.advanced_to is None and state.bookmark("public-users") == 20


class Two:
    """A database of one table with two rows."""

    def __init__(self, spark):
        self.spark = spark

    def discover(self, settings):
        raise AssertionError("the catalog is given")

    def scan(self, stream, where=()):
        return self.spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")


@pytest.mark.parametrize("bootstrap", [True, False])
def test_bootstrap_then_log(spark, tmp_path, bootstrap):
    folder = tmp_path / "log"
    put(folder, "a", (5000, message("I", id=("integer", 3), name=("text", "c"))))
    settings = Settings.of({"url": "postgresql://u:p@h/d", "auto_bootstrap_log_based": bootstrap, "replication_idle_exit_seconds": 0})
    state = State(value={"bookmarks": {"public-old": {"replication_key": "_sdc_lsn", "replication_key_value": 1234}}})
    streams = {"streams": [StreamSpec("public", t, {"id": {"type": "integer"}, "name": {"type": "string"}}, ("id",), (), LOG_BASED).to_entry() for t in ("users", "old")]}
    engine, sink = Engine(spark, settings, Two(spark), state, streams), Rows()
    engine.sync_log(sink, {"path": str(folder)})
    assert [r["id"] for r in sink.kept["public-users"]] == ([1, 2, 3] if bootstrap else [3])
    assert not sink.kept.get("public-old") and state.bookmark("public-users") == 5000
    kinds = [k for k, _ in sink.events]
    assert kinds[:2] == ["SCHEMA", "SCHEMA"] and kinds.count("SCHEMA") == 2


def test_waiting_run_reads_nothing_twice(spark, tmp_path):
    folder = tmp_path / "log"
    put(folder, "a", *((n, message("I", id=("integer", n))) for n in (10, 11, 12)))
    sink, state = Rows(), State()
    report = LogRun(spark, [spec()], state, sink, {"path": str(folder)}, Settings.of({"url": "postgresql://u:p@h/d", "replication_idle_exit_seconds": 2})).run()
    assert [r["id"] for r in sink.kept["public-users"]] == [10, 11, 12] and report.caught_up and report.counts == {"emitted": 3}
    put(folder, "b", (13, message("I", id=("integer", 13))))
    LogRun(spark, [spec()], state, sink, {"path": str(folder)}).run()
    assert [r["id"] for r in sink.kept["public-users"]] == [10, 11, 12, 12, 13]  # the message at the bookmark comes again: at least once


def test_failed_run_can_be_called_again(spark, tmp_path):
    folder = tmp_path / "log"
    put(folder, "a", (10, message("I", id=("integer", 1))))

    class Once(Rows):
        broken = True

        def rows(self, s, df):
            if self.broken:
                self.broken = False
                raise OSError("full")
            super().rows(s, df)

    sink = Once()
    run = LogRun(spark, [spec()], State(), sink, {"path": str(folder)})
    with pytest.raises(Exception, match="full"):
        run.run()
    assert run.run().by_stream == {"public-users": 1} and [r["id"] for r in sink.kept["public-users"]] == [1]


class Slot(wal.PostgresLog):
    """A replication slot whose server sends some messages and then nothing."""

    def __init__(self, messages, wal_end):
        super().__init__({"slot": "s"})
        self.messages, self.end, self.told = messages, wal_end, []

    def _replication(self):
        messages, end, told = list(self.messages), self.end, self.told

        class Sent:
            def __init__(self, lsn, payload):
                self.data_start, self.payload = lsn, payload

        class Cursor:
            wal_end = end

            def start_replication(self, **more):
                assert more["slot_name"] == "s" and more["options"]["include-transaction"] == "True"

            def read_message(self):
                return Sent(*messages.pop(0)) if messages else None

            def send_feedback(self, flush_lsn, **more):
                told.append(flush_lsn)

            def cursor(self):
                return self

            def __enter__(self):
                return self

            def __exit__(self, *error):
                return False

        return Cursor()

    def _wait(self, cur):
        pass


def test_silence_is_no_end():
    plain = lambda *at: [(n, f"m{n}") for n in at]
    assert [m.lsn for m in wal.read_range(Slot(plain(9, 10, 12, 30), 40), 10, 21)] == [10, 12]
    assert [m.lsn for m in wal.read_range(Slot(plain(10, 12), 20), 10, 21)] == [10, 12]
    with pytest.raises(TimeoutError):
        list(wal.read_range(Slot(plain(10, 12), 15), 10, 21, idle=0.2))


def test_slots_need_a_landing(spark):
    options = {"client": "tidemark.sources.wal:PostgresLog", "dsn": "", "slot": "s"}
    with pytest.raises(ValueError):
        LogRun(spark, [spec()], State(), Rows(), options).run()


def test_values_that_types_cannot_hold(spark, tmp_path):
    s = spec(id=T.LongType(), at=T.TimestampNTZType(), many=T.ArrayType(T.IntegerType()), n=T.DecimalType(38, 18))
    good = {"id": ("bigint", "1"), "at": ("timestamp", "2024-01-01 00:00:00"), "many": ("integer[]", "{1,NULL}"), "n": ("numeric", "")}
    rows = [(1, message("I", **good)), (2, message("I", **good | {"at": ("timestamp", "infinity")})), (3, message("I", **good | {"many": ("integer[]", "{1,x}")})), (4, message("I", **good | {"n": ("numeric", "1" * 24)})), (5, message("I", **good | {"id": ("bigint", None)}))]
    sink = Rows()
    run = LogRun(spark, [s], State(), sink, {}, quarantine=str(tmp_path / "bad"))
    for _ in range(2):
        run.batch(log(spark, *rows), 4)
    assert [r["_sdc_lsn"] for r in sink.kept["public-users"]] == [1, 5, 1, 5]
    bad = {r["lsn"]: r["reason"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {2: "uncastable: at", 3: "uncastable: many", 4: "uncastable: n"} and spark.read.parquet(str(tmp_path / "bad")).count() == 3
    assert run.report.counts["uncastable"] == 6


def test_nested_arrays(spark):
    df = spark.createDataFrame([("{{1,2},{3,4}}",), ('{"a{",{"b}",NULL},c}',)], "v string")
    assert [r[0] for r in df.select(array_items(F.col("v"))).collect()] == [["{1,2}", "{3,4}"], ["a{", '{"b}",NULL}', "c"]]


def test_columns_out_of_order_and_with_gaps(spark):
    s = spec(id=T.LongType(), a=T.StringType(), b=T.StringType())
    got = read(spark, s, (1, message("U", b=("text", "y"), id=("integer", 1))), (2, message("U", id=("integer", 2), a=("text", "x"), b=("text", "z"))))
    assert [tuple(r)[:3] for r in got.orderBy("_sdc_lsn").collect()] == [(1, None, "y"), (2, "x", "z")]


def test_many_streams_at_once(spark, tmp_path):
    from tidemark.operators.messages import FileSink

    specs = [spec(f"t{i}") for i in range(12)]
    rows = [(n, message("I", f"t{n % 10}", id=("integer", n))) for n in range(40)]
    sink = FileSink(str(tmp_path / "out"), "parquet", None)
    run = LogRun(spark, specs, State(), sink, {})
    run.batch(log(spark, *rows), 0)
    assert all(sink.frame(specs[i]).count() == 4 for i in range(10)) and sink.frame(specs[11]).count() == 0 and run.report.by_stream["public-t11"] == 0
