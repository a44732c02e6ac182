import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.config import INCREMENTAL, Settings
from tidemark.operators.messages import FileSink, FrameSink, MessageSink
from tidemark.operators.table_stream import bootstrap, dates_as_text, flattened, limited, mapped, new_bookmark, read_stream, where_all
from tidemark.plans.catalog import StreamSpec, of_frame
from tidemark.sources.tables import ParquetTables
from tidemark.streaming.run import Engine
from tidemark.streaming.state import State

URL = {"url": "postgresql://u:p@h/d"}


@pytest.fixture
def rows(spark):
    data = [("Alpha", datetime(2022, 10, 20)), ("Bravo", datetime(2022, 11, 20)), ("Zulu", None)]
    return spark.createDataFrame(data, "data string, updated_at timestamp_ntz")


def stream(df, **more):
    return StreamSpec(**{**of_frame("public", "t", df).__dict__, **more})


def test_start_leaves_null_keys_out(rows):
    s = stream(rows, method=INCREMENTAL, replication_key="updated_at")
    assert [r["data"] for r in read_stream(rows, s, None, datetime(2022, 11, 1)).collect()] == ["Bravo"]
    assert [r["data"] for r in read_stream(rows, s, None, datetime(2022, 11, 20)).collect()] == ["Bravo"]
    assert [r["data"] for r in read_stream(rows, s).collect()] == ["Zulu", "Alpha", "Bravo"]
    assert [r["data"] for r in read_stream(rows, s, Settings.of(URL | {"start_date": "2022-11-01T00:00:00"})).collect()] == ["Bravo"]


def test_predicates_limit_columns(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    s = stream(df, deselected=frozenset({"x"}))
    settings = Settings.of(URL | {"max_record_count": 20, "stream_options": {"public-t": {"custom_where_clauses": ["id % 2 = 0", "id % 3 = 0 OR id > 900"]}}})
    got = read_stream(df, s, settings)
    assert got.columns == ["id"] and got.count() == 20
    assert where_all(df, ["id % 2 = 0", "id % 3 = 0 OR id > 900"]).count() == sum(i % 2 == 0 and (i % 3 == 0 or i > 900) for i in range(1000))
    assert limited(df, 0).count() == limited(df, None).count() == 1000


def test_temporal_values(spark):
    df = spark.sql("SELECT DATE'2022-03-19' AS d, TIMESTAMP_NTZ'1918-02-03 13:00:01' AS t, '06:04:19.222000' AS c, '4713-04-03 BC' AS old")
    assert tuple(dates_as_text(df).first()) == ("2022-03-19", "1918-02-03T13:00:01.000000+00:00", "06:04:19.222000", "4713-04-03 BC")


def test_bootstrap_shape(spark):
    df = spark.createDataFrame([(42,)], "id long")
    s = stream(df).as_log_based()
    got = bootstrap(df, s)
    assert got.columns == ["id", "_sdc_deleted_at", "_sdc_lsn"] and tuple(got.first()) == (42, None, None)
    assert bootstrap(df, s, ["id > 50"]).count() == 0


def test_bookmark_never_goes_back(rows):
    assert new_bookmark(rows, "updated_at", datetime(2030, 1, 1)).first()[0] == datetime(2030, 1, 1)
    assert new_bookmark(rows.limit(0), "updated_at").first()[0] is None


def test_maps_and_flattening(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('a', 1, 'b', named_struct('c', 'x')) AS s")
    assert flattened(df).columns == ["id", "s__a", "s__b"] and flattened(df).first()["s__b"] == '{"c":"x"}'
    assert flattened(df, 2).columns == ["id", "s__a", "s__b__c"] and flattened(df, 0).columns == ["id", "s"]
    assert mapped(df, {"n": "id + 1", "s": None}).first().asDict() == {"id": 1, "n": 2}
    assert mapped(df, {"n": "id"}, keep="id > 5", otherwise_drop=True).columns == ["n"]


def test_json_kinds_survive(spark):
    from pyspark.sql import types as T

    from tidemark.functions.values import typed

    values = ['{"foo":"bar"}', "3.14", "22", "{}", '["bar","foo"]', "true", "nope{"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(F.to_json(typed(F.col("v"), F.lit("jsonb"), T.VariantType())).alias("j"))
    assert [r["j"] for r in df.collect()] == [*values[:-1], None]


def test_engine_and_sinks(spark, tmp_path):
    spark.range(10).select(F.col("id"), (F.col("id") * 2).alias("k")).write.parquet(str(tmp_path / "t.parquet"))
    tables = ParquetTables(spark, str(tmp_path), {"t": ("id",)})
    state = State(str(tmp_path / "state.json"))
    engine = Engine(spark, Settings.of(URL | {"default_replication_method": INCREMENTAL}), tables, state)
    spec = engine.catalog.streams[0]
    engine.catalog.streams[0] = StreamSpec(**{**spec.__dict__, "replication_key": "k"})
    lines = []
    engine.sync_tables(MessageSink(lines.append))
    assert '"SCHEMA"' in lines[0] and sum('"RECORD"' in x for x in lines) == 10 and '"STATE"' in lines[-1]
    assert State(str(tmp_path / "state.json")).bookmark("public-t") == 18
    sink = FrameSink()
    engine.sync_tables(sink)
    assert sink.frames["public-t"][0].count() == 1 and sink.events[0] == ("SCHEMA", "public-t")
    FileSink(str(tmp_path / "out"), "json", "gzip").rows(spec, spark.range(3))
    assert spark.read.json(str(tmp_path / "out/public-t")).count() == 3
    assert Engine(spark, Settings.of(URL | {"filter_schemas": ["new_schema"]}), tables).catalog.streams == []


KEYS = {
    "timestamp_ntz": [datetime(2024, 1, d, 3, 4, 5, 600) for d in range(1, 9)],
    "timestamp": [datetime(2024, 1, d, 3, 4, 5, 600) for d in range(1, 9)],
    "date": [date(2024, 1, d) for d in range(1, 9)],
    "decimal(30,10)": [Decimal(f"12345678901234567890.{d}") for d in range(1, 9)],
    "bigint": [2**60 + d for d in range(1, 9)],
    "double": [d / 3 for d in range(1, 9)],
    "string": [f"k{d:02d}é" for d in range(1, 9)],
}


@pytest.mark.parametrize("kind", KEYS)
def test_second_run_starts_at_the_bookmark(spark, tmp_path, kind):
    rows = [(i, k) for i, k in enumerate(KEYS[kind])]
    df = spark.createDataFrame(rows, f"id int, k {kind}")
    state, got = str(tmp_path / "state.json"), []
    for n, most in enumerate((4, 6, 8)):
        folder = tmp_path / f"run{n}"
        df.filter(F.col("id") < most).write.parquet(str(folder / "t.parquet"))
        tables = ParquetTables(spark, str(folder), {"t": ("id",)})
        engine = Engine(spark, Settings.of(URL | {"default_replication_method": INCREMENTAL}), tables, State(state))
        spec = engine.catalog.streams[0]
        engine.catalog.streams[0] = StreamSpec(**{**spec.__dict__, "replication_key": "k"})
        lines = []
        engine.sync_tables(MessageSink(lines.append))
        got.append([json.loads(x)["record"]["id"] for x in lines if '"RECORD"' in x])
    assert got == [[0, 1, 2, 3], [3, 4, 5], [5, 6, 7]]


def test_folder_sink_has_schema_and_state(spark, tmp_path):
    spec = stream(spark.range(3))
    sink = FileSink(str(tmp_path / "out"), "parquet", None)
    for _ in range(2):
        sink.rows(spec, spark.range(3), "_run=a/_batch=1")
    sink.rows(spec, spark.range(2), "_run=a/_batch=2")
    sink.state({"bookmarks": {"public-t": {"replication_key_value": 7}}})
    assert spark.read.parquet(str(tmp_path / "out/public-t")).count() == 5
    assert json.load(open(tmp_path / "out/_state.json"))["value"]["bookmarks"]["public-t"]["replication_key_value"] == 7
    assert json.load(open(tmp_path / "out/_schemas/public-t.json"))["stream"] == "public-t"


def test_messages_keep_microseconds_and_offsets(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-02 03:04:05.123456' AS a, TIMESTAMP'2024-01-02 03:04:05.123456+02:00' AS b")
    lines = []
    MessageSink(lines.append).rows(stream(df), df)
    assert json.loads(lines[-1])["record"] == {"a": "2024-01-02T03:04:05.123456", "b": "2024-01-02T01:04:05.123456+00:00"}
