"""Parts of tables, snapshots by chunks while the table changes, stream maps."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LOG_BASED, Settings
from tidemark.operators.images import latest
from tidemark.operators.messages import FileSink, FrameSink, MessageSink
from tidemark.plans.catalog import StreamSpec
from tidemark.plans.maps import Maps, StreamMap
from tidemark.sources import splits
from tidemark.sources.connection import Connection
from tidemark.sources.splits import Point, Statistics, page_predicates, predicates, statistics
from tidemark.sources.tables import JdbcTables
from tidemark.streaming.run import Engine, LogRun
from tidemark.streaming.state import State

URL = {"url": "postgresql://u:p@h/d"}


@pytest.mark.parametrize("kind", ["bigint", "string", "date", "decimal(12,2)", "double"])
@pytest.mark.parametrize("parts", [2, 7, 16])
def test_each_row_is_in_one_part_and_parts_are_even(spark, kind, parts):
    rng = random.Random(parts)
    values = [rng.choice([0, 0, 0, None, 1, *[rng.randrange(2, 3000)] * 6]) for _ in range(4000)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, id long")
    made = {"string": F.lpad(F.col("v").cast("string"), 5, "0"), "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v"))}.get(kind, F.col("v").cast(kind))
    df = df.select(made.alias("k"), "id")
    found = predicates("k", statistics(df, "k"), parts, "id")
    counts = df.select(*(F.coalesce(F.expr(p), F.lit(False)).cast("int").alias(f"p{i}") for i, p in enumerate(found)))
    total = counts.agg(F.count("*"), F.min(sum(map(F.col, counts.columns))), F.max(sum(map(F.col, counts.columns)))).first()
    assert tuple(total) == (4000, 1, 1)
    sizes = counts.agg(*(F.sum(c) for c in counts.columns)).first()
    assert max(sizes) <= 2 * 4000 / parts


def test_parts_of_odd_tables(spark):
    assert predicates("k", Statistics(()), 8) == [] and statistics(spark.createDataFrame([], "k long"), "k") == Statistics(())
    nulls = statistics(spark.createDataFrame([(None,)] * 5, "k long"), "k")
    assert nulls.nulls == 1 and predicates("k", nulls, 4) == []
    one = statistics(spark.createDataFrame([(7,)] * 9, "k long"), "k")
    assert [p for p in predicates("k", one, 3, "id") if "= 7" in p] == [f"k = 7 AND mod(abs(id), 3) = {i}" for i in range(3)]
    assert predicates("k", Statistics((Point("it's", 0.0), Point("zz", 1.0))), 1) == []
    assert "'it''s'" in " ".join(predicates("k", Statistics((Point("a", 0.0), Point("it's", 0.5), Point("zz", 0.5))), 2))
    assert page_predicates(10, 3) == ["ctid < '(3,0)'::tid", "ctid >= '(3,0)'::tid AND ctid < '(6,0)'::tid", "ctid >= '(6,0)'::tid"] and page_predicates(0, 4) == page_predicates(9, 1) == []


def test_what_a_database_is_asked(spark):
    asked = []

    class Answers(JdbcTables):
        def _ask(self, query):
            asked.append(query)
            return [{"value": v, "weight": w, "common": c, "nulls": 0.1} for v, w, c in (("1", 0.4, True), ("2", 0.0, False), ("50", 0.25, False), ("99", 0.25, False))] if "pg_stats" in query else [{"relpages": 100, "reltuples": 5.0}]

    tables = Answers(spark, Connection("h", 1, "d", "u", "p"))
    s = StreamSpec("public", "o'x", {"id": {"type": "integer"}}, ("id",), types={"id": T.LongType()})
    got = tables.splits(s, 4)
    assert "tablename = 'o''x'" in asked[0] and "::bigint[]" in asked[0] and "\"id\" = '1' AND mod(abs((ctid::text::point)[0]::bigint), 2) = 1" in got and got[-1] == '"id" IS NULL'
    assert len(tables.splits(StreamSpec("public", "t", {"x": {"type": "string"}}), 4)) == 4


class Moving:
    """A table that changes while it is read: each look at the log's tip lets some changes happen."""

    def __init__(self, spark, folder, rng):
        self.spark, self.folder, self.rng, self.rows, self.at = spark, folder, rng, {i: f"v{i}" for i in range(60)}, 100
        folder.mkdir()

    def change(self):
        lines = []
        for _ in range(4):
            self.at += 2
            k = self.rng.randrange(80)
            if k in self.rows and self.rng.random() < 0.3:
                del self.rows[k]
                lines.append((self.at, {"action": "D", "identity": [{"name": "id", "type": "bigint", "value": k}]}))
            else:
                whole = k not in self.rows or self.rng.random() < 0.5
                cells = [{"name": "id", "type": "bigint", "value": k}] + ([{"name": "name", "type": "text", "value": f"n{self.at}"}] if whole else [])
                lines.append((self.at, {"action": "U" if k in self.rows else "I", "columns": cells}))
                if whole:
                    self.rows[k] = f"n{self.at}"
        with open(self.folder / f"{self.at:06d}.jsonl", "w") as f:
            f.writelines(json.dumps({"lsn": n, "payload": json.dumps({"schema": "public", "table": "t"} | p)}) + "\n" for n, p in lines)

    def discover(self, settings):
        raise AssertionError("the catalog is given")

    def splits(self, stream, parts):
        return [f"id % {parts} = {i}" for i in range(parts)]

    def scan(self, stream, where=()):
        self.change()
        df = self.spark.createDataFrame(list(self.rows.items()), "id long, name string")
        for w in where:
            df = df.filter(w)
        self.change()
        return df


@pytest.mark.parametrize("broken", [1, 3])
def test_a_snapshot_that_is_broken_off_goes_on(spark, tmp_path, broken):
    tables = Moving(spark, tmp_path / "log", random.Random(broken))
    tables.change()
    s = StreamSpec("public", "t", {"id": {"type": "integer"}, "name": {"type": "string"}}, ("id",), (), LOG_BASED, types={"id": T.LongType(), "name": T.StringType()})
    settings = Settings.of(URL | {"auto_bootstrap_log_based": True, "bootstrap_chunks": 4, "replication_idle_exit_seconds": 0})

    class Sink(FileSink):
        left = broken

        def rows(self, spec, df, part=None):
            if self.left == 0:
                raise OSError("killed")
            self.left -= 1
            super().rows(spec, df, part)

    state = State(str(tmp_path / "state.json"))
    with pytest.raises(OSError):
        Engine(spark, settings, tables, state, {"streams": [s.to_entry()]}).sync_log(Sink(str(tmp_path / "out"), "parquet", None), {"path": str(tmp_path / "log")})
    state = State(str(tmp_path / "state.json"))
    assert state.value["bootstrap"]["public-t"]["done"] == broken
    sink = FileSink(str(tmp_path / "out"), "parquet", None)
    Engine(spark, settings, tables, state, {"streams": [s.to_entry()]}).sync_log(sink, {"path": str(tmp_path / "log")})
    assert "public-t" not in state.value["bootstrap"] and state.bookmark("public-t") == tables.at
    log = sink.frame(s.as_log_based(), presence=True)
    snapshot = spark.read.parquet(str(tmp_path / "out/public-t")).drop("_chunk").withColumns({"_present_cols": F.array(F.lit("id"), F.lit("name")), "_sdc_lsn": F.lit(0).cast("long")})
    assert {tuple(r) for r in latest(snapshot.unionByName(log), ["id"], ["name"]).collect()} == set(tables.rows.items())


def spec(**kinds):
    from tidemark.functions.types import json_schema

    return StreamSpec("public", "t", {c: json_schema(k) for c, k in kinds.items()}, ("id",), ("id",), types=kinds)


def test_maps_make_rows_and_schemas(spark):
    s = spec(id=T.LongType(), name=T.StringType(), n=T.IntegerType())
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 7)], "id long, name string, n int")
    maps = Maps({"public-t": {"n": "n * 1.5", "name": None, "up": "upper(name)", "__filter__": "n > 5", "__alias__": "other"}, "copy": {"__source__": "public-t", "key": "id", "__key_properties__": ["key"], "__else__": None}})
    (own, copy), (a, b) = maps.specs(spark, [s]), maps.of("public-t")
    assert a.frame(df).collect()[0].asDict() == {"id": 2, "up": "B", "n": 10.5} or [str(x) for x in a.frame(df).collect()[0]] == ["2", "10.5", "B"]
    assert own.name == "public-other" and list(own.properties) == ["id", "n", "up"] and own.properties["up"] == {"type": ["string", "null"]} and own.keys == ("id",) and own.required == ("id",) and isinstance(own.types["n"], T.DecimalType)
    assert copy.name == "public-copy" and list(copy.properties) == ["key"] and copy.keys == ("key",) and [r[0] for r in b.frame(df).collect()] == [1, 2]
    assert maps.plain("public-x") and not maps.plain("public-t") and Maps({"public-t": None}).of("public-t") == [] and Maps(None).plain("x")


@pytest.mark.parametrize("config", [{"public-t": {"__what__": 1}}, {"public-t": {"__else__": 5}}, {"public-t": {"a": "id", "A": "id"}}, {"public-t": {"__key_properties__": ["gone"]}}, {"public-t": {"__alias__": "same"}, "x": {"__source__": "public-t", "__alias__": "same"}}])
def test_maps_that_cannot_be(spark, config):
    with pytest.raises(ValueError):
        Maps(config).specs(spark, [spec(id=T.LongType())])


def test_maps_of_tables_and_of_the_log(spark, tmp_path):
    settings = Settings.of(URL | {"stream_maps": {"public-t": {"name": "upper(name)", "__filter__": "id > 1"}, "few": {"__source__": "public-t", "id": "id", "__else__": None}}, "replication_idle_exit_seconds": 0})

    class Two:
        def __init__(self, kind):
            self.kind = kind

        def discover(self, settings):
            raise AssertionError

        def scan(self, stream, where=()):
            return spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")

    s = spec(id=T.LongType(), name=T.StringType())
    sink = FrameSink()
    Engine(spark, settings, Two("x"), State(), {"streams": [s.to_entry()]}).sync_tables(sink)
    assert [tuple(r) for r in sink.frames["public-t"][0].collect()] == [(2, "B")] and [tuple(r) for r in sink.frames["public-few"][0].collect()] == [(1,), (2,)]
    log = [(n, json.dumps({"action": "I", "schema": "public", "table": t, "columns": [{"name": "id", "type": "bigint", "value": n}, {"name": "name", "type": "text", "value": "z"}]})) for n, t in ((1, "t"), (2, "t"), (3, "plain"))]
    streams = [s.as_log_based(), StreamSpec(**{**s.__dict__, "table": "plain"}).as_log_based()]
    for kind in (FrameSink, MessageSink):
        lines = []
        sink = kind() if kind is FrameSink else kind(lines.append)
        LogRun(spark, streams, State(), sink, {}, settings).batch(spark.createDataFrame(log, "lsn long, payload string"))
        if kind is FrameSink:
            assert [r["name"] for r in sink.frames["public-t"][0].collect()] == ["Z"] and sink.frames["public-few"][0].columns == ["id", "_sdc_deleted_at", "_sdc_lsn"] and sink.frames["public-few"][0].count() == 2
        else:
            records = [json.loads(x) for x in lines if '"RECORD"' in x]
            assert [(r["stream"], r["record"].get("name"), r["record"]["_sdc_lsn"]) for r in records] == [("public-few", None, 1), ("public-few", None, 2), ("public-t", "Z", 2), ("public-plain", "z", 3)] or sorted((r["stream"], r["record"]["_sdc_lsn"]) for r in records) == [("public-few", 1), ("public-few", 2), ("public-plain", 3), ("public-t", 2)]


def test_an_alias_that_is_a_reader_of_columns_sees_them_as_they_were(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert StreamMap.of("t", {"a": "b", "b": "a"}).frame(df).first().asDict() == {"a": 2, "b": 1} and splits.literal(1.5) == "1.5"
