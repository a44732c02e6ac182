"""Sinks: messages as JSON lines, or batches of files. Rows become JSON in the JVM."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.identifiers import quoted
from tidemark.operators.decode import JSON_TIMES
from tidemark.plans.catalog import DELETED, LSN, StreamSpec


def record_lines(df: DataFrame, stream: str, ignore_nulls: bool = False) -> DataFrame:
    """A RECORD message for each row, as column ``value``. Times have microseconds, and those of a zone their offset."""
    record = F.struct(*(quoted(c).alias(c) for c in df.columns))
    envelope = F.struct(F.lit("RECORD").alias("type"), F.lit(stream).alias("stream"), record.alias("record"))
    return df.select(F.to_json(envelope, {"ignoreNullFields": str(ignore_nulls).lower(), **JSON_TIMES}).alias("value"))


def schema_message(spec: StreamSpec) -> dict[str, Any]:
    out = {"type": "SCHEMA", "stream": spec.name, "schema": spec.to_json_schema(), "key_properties": list(spec.keys)}
    return out | ({"bookmark_properties": [spec.replication_key]} if spec.replication_key else {})


def state_message(value: dict[str, Any]) -> dict[str, Any]:
    return {"type": "STATE", "value": value}


def in_log_order(values: DataFrame, *first: str) -> DataFrame:
    """Rows of a batch in the order of the log, over all parts, which are numbered by it."""
    order = [*first, "position", "seq", "lsn"]
    return values.repartitionByRange(*order).sortWithinPartitions(*order)


class MessageSink:
    """Messages in order, to a function that takes a line: a stream's SCHEMA before its rows, and again when it has changed, then RECORDs, then STATE.

    A message stream is one line after the other, so rows pass through the
    driver, a partition at a time.  For large tables use ``FileSink``.  Rows of
    the log have the columns that their messages have; those of a table have all.
    """

    def __init__(self, emit: Callable[[str], Any] = print):
        self.emit, self.announced = emit, {}

    def schema(self, spec: StreamSpec) -> None:
        message = schema_message(spec)
        if self.announced.get(spec.name) != message:
            self.announced[spec.name] = message
            self.emit(json.dumps(message))

    def schemas(self, specs: Iterable[StreamSpec]) -> None:
        for s in specs:
            self.schema(s)

    def rows(self, spec: StreamSpec, df: DataFrame, part: str | None = None) -> None:
        self.schema(spec)
        for r in record_lines(df, spec.name).toLocalIterator():
            self.emit(r["value"])

    def batch(self, values: DataFrame, specs: Iterable[StreamSpec], part: str) -> None:
        """Rows of all streams (see ``record_values``) in the order of the log."""
        self.schemas(specs)
        for r in in_log_order(values).select("_stream", "value").toLocalIterator():
            self.emit(f'{{"type":"RECORD","stream":{json.dumps(r["_stream"])},"record":{r["value"]}}}')

    def state(self, value: dict[str, Any]) -> None:
        self.emit(json.dumps(state_message(value), default=str))


class FileSink:
    """Files below a folder, written by the executors, with ``_schemas/<stream>.json`` and ``_state.json`` beside them.

    Rows of a table are in ``<stream>/``.  Rows of the log are written batch by batch, those of all streams by one job, as JSON
    text in ``_log/<part>/_stream=<stream>/``: one line a row (``json``), or one column ``value`` (``parquet``), in the order of
    the log from file to file.  Such a row has the columns that its message has, so one that was missing and one that was set to
    null stay apart.

    A batch counts when it has its entry in ``_commits/``, which appears as a whole: ``frame`` reads what is committed and nothing
    else, so no reader sees a batch of which some streams are missing, nor one that is tried again twice.
    """

    def __init__(self, folder: str, fmt: str = "json", compression: str | None = "gzip", records_per_file: int | None = None):
        self.folder, self.fmt, self.compression, self.most, self.announced = folder, fmt, compression, records_per_file, {}
        self.states: list[dict[str, Any]] = []

    @property
    def quarantine(self) -> str:
        return f"{self.folder}/_quarantine"

    def _put(self, name: str, value: dict[str, Any]) -> None:
        """A small file that appears as a whole in place of what was there, wherever the folder is."""
        spark = SparkSession.active()
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        path, new = (jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{n}") for n in (name, f"{name.rpartition('/')[0] or '.'}/.new-{uuid.uuid4().hex}"))
        out = new.getFileSystem(conf).create(new, True)
        try:
            out.write(bytearray(json.dumps(value, default=str, sort_keys=True).encode()))
        finally:
            out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(kind, 1)
        how[0] = kind.OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.getFileSystem(conf).getUri(), conf)
        files.rename(new.makeQualified(new.getFileSystem(conf).getUri(), new.getFileSystem(conf).getWorkingDirectory()), path.makeQualified(new.getFileSystem(conf).getUri(), new.getFileSystem(conf).getWorkingDirectory()), how)

    def schema(self, spec: StreamSpec) -> None:
        message = schema_message(spec)
        if self.announced.get(spec.name) != message:
            self.announced[spec.name] = message
            self._put(f"_schemas/{spec.name}.json", message)

    def schemas(self, specs: Iterable[StreamSpec]) -> None:
        for s in specs:
            self.schema(s)

    def _writer(self, df: DataFrame, mode: str, fmt: str):
        writer = df.write.mode(mode).format(fmt)
        writer = writer.option("compression", self.compression) if self.compression else writer
        return writer.option("maxRecordsPerFile", self.most) if self.most else writer

    def rows(self, spec: StreamSpec, df: DataFrame, part: str | None = None) -> None:
        self.schema(spec)
        writer = self._writer(df, "overwrite" if part else "append", self.fmt)
        writer = writer.options(ignoreNullFields="false", **JSON_TIMES) if self.fmt == "json" else writer
        writer.save(f"{self.folder}/{spec.name}/{part}" if part else f"{self.folder}/{spec.name}")

    def batch(self, values: DataFrame, specs: Iterable[StreamSpec], part: str) -> None:
        """Rows of all streams (see ``record_values``), by one job; they replace what an earlier try left."""
        self.schemas(specs)
        rows = in_log_order(values, "_stream").select("value", "_stream")
        self._writer(rows, "overwrite", "text" if self.fmt == "json" else self.fmt).partitionBy("_stream").save(f"{self.folder}/_log/{part}")

    def commit(self, part: str, entry: dict[str, Any]) -> None:
        """Makes a batch count."""
        self._put(f"_commits/{part.replace('/', ',')}.json", {"part": part, **entry})

    def committed(self) -> list[dict[str, Any]]:
        """Entries of all batches that count."""
        spark = SparkSession.active()
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/_commits")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            return []
        return [json.loads(r["value"]) for r in spark.read.text(f"{self.folder}/_commits", wholetext=True).collect()]

    def frame(self, spec: StreamSpec, presence: bool = False) -> DataFrame:
        """Committed rows of a stream of the log, typed by its columns; with ``presence`` also ``_present_cols``, the columns that a row's message had."""
        spark = SparkSession.active()
        parts = [f"{self.folder}/_log/{e['part']}" for e in self.committed() if e.get("streams", {}).get(spec.name)]
        fields = [T.StructField(c, spec.type_of(c)) for c in spec.real_columns] + [T.StructField(DELETED, T.StringType()), T.StructField(LSN, T.LongType())]
        if not parts:
            empty = [T.StructField("_present_cols", T.ArrayType(T.StringType()))] if presence else []
            return spark.createDataFrame([], T.StructType([*fields, *empty]))
        read = spark.read.schema("value string, _run string, _batch string, _stream string").option("basePath", f"{self.folder}/_log")
        rows = read.format("text" if self.fmt == "json" else self.fmt).load(parts).filter(F.col("_stream") == spec.name)
        rows = rows.select("value", F.from_json("value", T.StructType(fields), JSON_TIMES).alias("r"))
        present = [F.filter(F.json_object_keys("value"), lambda k: ~k.isin(DELETED, LSN)).alias("_present_cols")] if presence else []
        return rows.select(*(F.col("r").getField(f.name).alias(f.name) for f in fields), *present)

    def state(self, value: dict[str, Any]) -> None:
        self.states.append(json.loads(json.dumps(value, default=str)))
        self._put("_state.json", state_message(self.states[-1]))


class FrameSink:
    """Rows of each stream as DataFrames, for queries and tests."""

    def __init__(self):
        self.frames: dict[str, list[DataFrame]] = {}
        self.events: list[tuple[str, str]] = []
        self.states: list[dict[str, Any]] = []
        self.announced: dict[str, dict[str, Any]] = {}

    def schema(self, spec: StreamSpec) -> None:
        message = schema_message(spec)
        if self.announced.get(spec.name) != message:
            self.announced[spec.name] = message
            self.events.append(("SCHEMA", spec.name))

    def schemas(self, specs: Iterable[StreamSpec]) -> None:
        for s in specs:
            self.schema(s)

    def rows(self, spec: StreamSpec, df: DataFrame, part: str | None = None) -> None:
        self.schema(spec)
        self.events.append(("RECORD", spec.name))
        self.frames.setdefault(spec.name, []).append(df)

    def state(self, value: dict[str, Any]) -> None:
        self.states.append(json.loads(json.dumps(value, default=str)))
