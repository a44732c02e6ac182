"""The write-ahead log: messages in the order of commits, and a streaming source of them.

A slot sends whole transactions, one after the other by their commits, while each
change has the position at which it was made.  Transactions overlap, so changes
are not in order of their own positions, and a range of those would cut
transactions apart.  What a run has read is therefore told by commits: a message
between the plugin's begin and commit frames has the commit's position and its
number within it; a message without frames is a commit of its own.

What speaks to a server is a small client class, named by an option, so that
tests use one that reads files.  ``PostgresLog`` is untested against a server:
none can be reached from here.  Slot reads can't be repeated once the server has
been told that they were processed, so a run lands messages first; see
``sources.segments``.
"""

from __future__ import annotations

import importlib
import json
import re
import select
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from typing import NamedTuple, Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.json as pajson
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.functions.lsn import format_lsn, parse_lsn

FORMAT = "tidemark_wal"
#: A message's own position and text; the position of its commit and its number within it, null for one without frames.
SCHEMA = "lsn bigint, payload string, commit bigint, seq bigint"

_FRAME = re.compile(r'\s*\{\s*"action"\s*:\s*"([BC])"')
#: For Arrow, which knows less white space: matches all of those, and seldom more.
_FRAMED = r'^[^"]*"action"[^"]*"[BC]"'
#: A message as clients give it.
MESSAGE = pa.schema([("lsn", pa.int64()), ("payload", pa.string())])


class WalClient(Protocol):
    """A client is made from the source's options, on the driver and in tasks.

    One that reads much at a time may have ``blocks`` too, which gives the messages of ``follow`` as Arrow tables.
    """

    #: How far the log had been sent when it was last silent; None if that isn't known.
    wal_end: int | None

    def tip(self) -> int | None: ...
    def follow(self, start: int) -> Iterator[tuple[int, str] | None]: ...
    def feedback(self, lsn: int) -> None: ...


def replication_options(add_tables: str, frames: bool = False) -> dict[str, str]:
    """Options of the decoding plugin: one message a change, some tables only, and the frames of transactions where they are wanted."""
    return {"format-version": "2", "include-transaction": str(frames), "add-tables": add_tables}


def frame_of(payload: str | None) -> str | None:
    """B or C for the frames of a transaction."""
    found = _FRAME.match(payload) if payload else None
    return found[1] if found else None


def has_frames(block: pa.Table) -> bool:
    return bool(pc.any(pc.match_substring_regex(block["payload"], _FRAMED)).as_py())


def messages_of(block: pa.Table) -> Iterator[tuple[int, str | None]]:
    return zip(block["lsn"].to_pylist(), block["payload"].to_pylist())


class Message(NamedTuple):
    lsn: int
    payload: str | None
    commit: int | None
    seq: int | None

    @property
    def position(self) -> int:
        return self.lsn if self.commit is None else self.commit


def positioned(messages: Iterable[tuple[int, str] | None]) -> Iterator[Message | None]:
    """Messages with their commits; None where the log was silent. A transaction is held until its commit, and one that has none yet isn't given."""
    held: list[tuple[int, str]] | None = None
    for m in messages:
        if m is None:
            yield None
            continue
        lsn, payload = m
        frame = frame_of(payload)
        if frame == "B":
            held = []
        elif frame == "C":
            yield from (Message(at, text, lsn, i) for i, (at, text) in enumerate(held or ()))
            held = None
        elif held is None:
            yield Message(lsn, payload, None, None)
        else:
            held.append((lsn, payload))


class DirectoryLog:
    """A log in a folder of JSON lines ``{"lsn": n, "payload": "..."}``, on any file system that Arrow knows; feedback goes to a file beside them.

    Files are in the order of their names.  Of each file is remembered where its last commit is and whether it ends
    within a transaction, and every ``BLOCK_BYTES`` what it has up to there, so that one that is read again starts where
    news can be.  The option ``known`` names a file, on the same file system, that keeps this from process to process.
    """

    #: Whether messages can still be read after feedback.
    replayable = True
    #: What is read and parsed at a time.
    BLOCK_BYTES = 4 << 20
    _ends: dict[str, tuple[int | None, bool, int | None, list[list[int]]]] = {}

    def __init__(self, options: Mapping[str, str]):
        path = options["path"]
        if path.startswith("file:"):
            path = "/" + path[5:].lstrip("/")
        self.fs, self.folder = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
        self.options, self._scanned = options, False
        self.wal_end: int | None = None

    def _files(self) -> list[pafs.FileInfo]:
        found = self.fs.get_file_info(pafs.FileSelector(self.folder))
        return sorted((f for f in found if f.path.endswith((".json", ".jsonl"))), key=lambda f: f.path)

    def _blocks(self, path: str, at: int = 0) -> Iterator[tuple[pa.Table, int]]:
        """A file's messages from the line that begins at a byte, in blocks of whole lines, each with the byte behind it."""
        rest = b""
        with self.fs.open_input_file(path) as f:
            f.seek(at)
            while some := f.read(self.BLOCK_BYTES):
                end = some.rfind(b"\n") + 1
                if not end:
                    rest += some
                    continue
                text, rest = rest + some[:end], some[end:]
                at += len(text)
                yield self._parsed(text), at
            if rest.strip():
                yield self._parsed(rest), at + len(rest)

    @staticmethod
    def _parsed(text: bytes) -> pa.Table:
        try:
            how = pajson.ParseOptions(explicit_schema=MESSAGE, unexpected_field_behavior="ignore")
            return pajson.read_json(pa.BufferReader(text), pajson.ReadOptions(use_threads=False, block_size=len(text) + 1), how).combine_chunks()
        except pa.ArrowInvalid:  # what only the other parser reads, and else raises with its own words
            rows = [json.loads(line) for line in text.decode().split("\n") if line]
            return pa.table([[r["lsn"] for r in rows], [r.get("payload") for r in rows]], schema=MESSAGE)

    def _end(self, f: pafs.FileInfo, inside: bool) -> tuple[int | None, bool, int | None, list[list[int]]]:
        """A file's last commit, whether it ends within a transaction (as it begins with ``inside``), its greatest position, and marks.

        A mark is a byte behind which a transaction or a message without one begins, and the last commit before it.
        """
        key = f"{f.path} {f.size} {f.mtime_ns} {inside}"
        if key not in self._ends:
            self._ends.update(self._known())
        if key not in self._ends:
            last = top = None
            marks: list[list[int]] = []
            for block, at in self._blocks(f.path):
                most = pc.max(block["lsn"]).as_py()
                top = most if top is None else max(top, most)
                if has_frames(block):
                    for lsn, payload in messages_of(block):
                        frame = frame_of(payload)
                        inside = frame == "B" or (inside and frame != "C")
                        if not inside:
                            last = lsn if last is None else max(last, lsn)
                elif not inside:
                    last = most if last is None else max(last, most)
                if not inside and last is not None:
                    marks.append([at, last])
            self._ends[key] = (last, inside, top, marks)
            self._scanned = True
        return self._ends[key]

    def _known(self) -> dict[str, tuple]:
        """What the file of the option ``known`` has of the log's files, for processes that have not read them."""
        path = self.options.get("known")
        if not path or self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            return {}
        with self.fs.open_input_stream(path) as f:
            return {k: tuple(v) for k, v in json.loads(f.read()).items()}

    def _remember(self, files: list[pafs.FileInfo]) -> None:
        path = self.options.get("known")
        if path and self._scanned:
            here = {f"{f.path} {f.size} {f.mtime_ns} {i}" for f in files for i in (True, False)}
            self.fs.create_dir(path.rpartition("/")[0], recursive=True)
            made = f"{path}.{uuid.uuid4().hex}"
            with self.fs.open_output_stream(made) as f:
                f.write(json.dumps({k: v for k, v in self._ends.items() if k in here}).encode())
            self.fs.move(made, path)
            self._scanned = False

    def tip(self) -> int | None:
        return self._top(self._files())

    def _top(self, files: list[pafs.FileInfo]) -> int | None:
        top, inside = None, False
        for f in files:
            _, inside, most, _ = self._end(f, inside)
            top = most if top is None else top if most is None else max(top, most)
        self._remember(files)
        return top

    def follow(self, start: int) -> Iterator[tuple[int, str] | None]:
        for block in self.blocks(start):
            if block is None:
                yield None
            else:
                yield from messages_of(block)

    def blocks(self, start: int) -> Iterator[pa.Table | None]:
        """From the last mark before which all commits are before the start, or the file that has none such, once to the end."""
        files, first, inside, at = self._files(), 0, False, 0
        for i, f in enumerate(files):
            last, ends_inside, _, marks = self._end(f, inside)
            if last is not None and last >= start:
                before = [byte for byte, commit in marks if commit < start]
                if before:
                    first, at = i, before[-1]
                break
            inside = ends_inside
            if not inside:
                first = i + 1
        for f in files[first:]:
            for block, _ in self._blocks(f.path, at):
                yield block
            at = 0
        self.wal_end = self._top(files)
        yield None

    def feedback(self, lsn: int) -> None:
        path = f"{self.folder}/feedback"
        with self.fs.open_output_stream(f"{path}.tmp") as f:
            f.write(str(lsn).encode())
        self.fs.move(f"{path}.tmp", path)

    def acknowledged(self) -> int | None:
        path = f"{self.folder}/feedback"
        if self.fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with self.fs.open_input_stream(path) as f:
            return int(f.read())


class PostgresLog:
    """A logical replication slot. Options: dsn, slot, add_tables, keepalive_seconds."""

    replayable = False

    def __init__(self, options: Mapping[str, str]):
        self.options = options
        self.wal_end: int | None = None
        self._cursor = None

    def _connect(self, **more):
        import psycopg2

        return psycopg2.connect(self.options["dsn"], **more)

    def tip(self) -> int | None:
        """The server's flushed position; None if it can't be had."""
        try:
            with self._connect() as c:
                c.autocommit = True
                with c.cursor() as cur:
                    cur.execute("SELECT pg_current_wal_flush_lsn()")
                    return parse_lsn(cur.fetchone()[0])
        except Exception:  # whatever the driver raises: the tip is only an aim
            return None

    def _replication(self):
        from psycopg2.extras import LogicalReplicationConnection

        return self._connect(connection_factory=LogicalReplicationConnection)

    def _start(self, cur, **more) -> None:
        cur.start_replication(slot_name=self.options["slot"], decode=True, options=replication_options(self.options.get("add_tables", ""), frames=True), **more)

    def follow(self, start: int) -> Iterator[tuple[int, str] | None]:
        """Messages as the slot sends them, for as long as they are asked for; None after each second of silence."""
        with self._replication() as c, c.cursor() as cur:
            self._start(cur, start_lsn=format_lsn(start), status_interval=int(self.options.get("keepalive_seconds", 10)))
            self._cursor = cur
            try:
                while True:
                    message = cur.read_message()
                    self.wal_end = cur.wal_end or self.wal_end
                    if message is None:
                        yield None
                        self._wait(cur)
                    else:
                        yield message.data_start, message.payload
            finally:
                self._cursor = None

    def _wait(self, cur) -> None:
        select.select([cur], [], [], 1)

    def feedback(self, lsn: int) -> None:
        """By the connection that reads, if there is one."""
        if self._cursor is not None:
            self._cursor.send_feedback(write_lsn=lsn, flush_lsn=lsn, force=True)
            return
        with self._replication() as c, c.cursor() as cur:
            self._start(cur)
            cur.send_feedback(write_lsn=lsn, flush_lsn=lsn, force=True)


def client_of(options: Mapping[str, str]) -> WalClient:
    module, _, name = options.get("client", "tidemark.sources.wal:DirectoryLog").partition(":")
    return getattr(importlib.import_module(module), name)(options)


def read_range(client: WalClient, start: int, end: int, idle: float = 60) -> Iterator[Message]:
    """All messages whose commits are in ``[start, end)``, or ``TimeoutError``.

    The range is read when a commit beyond it comes, or the log says that it has
    sent all up to its end.  Silence alone ends nothing: what is taken for read is
    confirmed, and a slot can't give it again.
    """
    last = time.monotonic()
    for m in positioned(client.follow(start)):
        if m is None:
            if (client.wal_end or 0) >= end - 1:
                return
            if time.monotonic() - last >= idle:
                raise TimeoutError(f"the log ended before {format_lsn(end - 1)}: nothing for {idle} s")
            continue
        last = time.monotonic()
        if m.position >= end:
            if m.commit is not None:
                return
        elif m.position >= start:
            yield m


def with_commits(log: DataFrame) -> DataFrame:
    """A log of ``lsn, payload`` with the columns of commits, null where it has none."""
    have = {c.lower() for c in log.columns}
    return log.withColumns({c: F.lit(None).cast("bigint") for c in ("commit", "seq") if c not in have})


class LogRange(InputPartition):
    def __init__(self, start: int, end: int):
        self.start, self.end = start, end


class WalReader(DataSourceStreamReader):
    """Offsets are ``{"lsn": n}``, one past the last commit read. A slot is one reader: one partition a batch."""

    def __init__(self, options: Mapping[str, str]):
        self.options = dict(options)

    def initialOffset(self) -> dict:
        return {"lsn": int(self.options.get("start_lsn", 0))}

    def latestOffset(self) -> dict:
        tip = client_of(self.options).tip()
        first = int(self.options.get("start_lsn", 0))
        limit = self.options.get("end_lsn")
        end = first if tip is None else max(first, tip + 1)
        return {"lsn": min(end, int(limit)) if limit else end}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [LogRange(start["lsn"], end["lsn"])] if end["lsn"] > start["lsn"] else []

    def read(self, partition: LogRange) -> Iterator[tuple]:
        idle = float(self.options.get("idle_seconds", 60))
        return (tuple(m) for m in read_range(client_of(self.options), partition.start, partition.end, idle))

    def commit(self, end: dict) -> None:
        """Called one batch late, so a run sends its last feedback itself."""
        if self.options.get("feedback", "true") == "true":
            client_of(self.options).feedback(end["lsn"] - 1)


class WalSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> WalReader:
        return WalReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WalSource)
