"""Routing one log to many streams: parse, drop what isn't data, route, filter by position, classify, count."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.identifiers import table_filter
from tidemark.operators.decode import EMITTED, FILTERED, MALFORMED, NON_DATA, QUARANTINED, UNKNOWN, UNROUTABLE, action_of, decoded, message_route
from tidemark.plans.catalog import StreamSpec
from tidemark.sources.wal import with_commits


class Routes:
    """The streams of a log and where each starts. A table may be registered once.

    ``starts`` are positions, which count themselves; ``done`` are commits of which nothing is wanted any more.
    """

    def __init__(self, streams: Iterable[StreamSpec], starts: Mapping[str, int] | None = None, done: Mapping[str, int] | None = None):
        self.streams = list(streams)
        if not self.streams:
            raise ValueError("a log needs a stream at least")
        if any(not s.schema for s in self.streams):
            raise ValueError("a stream of a log needs a schema name")
        seen = [s.route for s in self.streams]
        if twice := sorted({s.name for s in self.streams if seen.count(s.route) > 1}):
            raise ValueError(f"registered twice: {', '.join(twice)}")
        self.starts = {s.name: int((starts or {}).get(s.name) or 0) for s in self.streams}
        self.done = {s.name: int((done or {}).get(s.name, -1)) for s in self.streams}

    @property
    def global_start(self) -> int:
        """The log is read from the least start; a stream without one starts at 0."""
        return min(self.starts.values())

    @property
    def tables(self) -> list[tuple[str, str]]:
        return [(s.schema, s.table) for s in self.streams]

    @property
    def add_tables(self) -> str:
        return table_filter(self.tables)


def position() -> Column:
    """Where a message counts: at its commit, or where it has no frames at its own place."""
    return F.coalesce("commit", "lsn")


def dispatched(log: DataFrame, routes: Routes) -> DataFrame:
    """``lsn, payload, commit, seq, msg, stream, disposition``: what becomes of each message.

    Streams and starts are literals of the plan: no join, no shuffle.  A message
    at its stream's start is kept: at least once; but of a commit that its stream
    has done nothing comes again.  Transactions overlap, so it is the commit's
    position that counts, not the change's own.
    """
    log = with_commits(log)
    by_route = lambda of: F.create_map(*chain.from_iterable((F.lit(s.route), F.lit(of[s.name])) for s in routes.streams))
    names = by_route({s.name: s.name for s in routes.streams})
    first = F.try_element_at(by_route(routes.starts), "route")
    done = F.try_element_at(by_route(routes.done), "route")
    msg = F.col("msg")
    with_route = decoded(log).withColumn("route", message_route(msg)).withColumn("stream", F.try_element_at(names, "route"))
    what = (
        F.when(msg.isNull(), MALFORMED)
        .when(msg["schema"].isNull() | msg["table"].isNull(), NON_DATA)
        .when(F.col("stream").isNull(), UNROUTABLE)
        .when((position() < first) | (F.col("commit").isNotNull() & (F.col("commit") <= done)), FILTERED)
        .otherwise(action_of(msg))
    )
    return with_route.withColumn("disposition", what).drop("route")


def counters(messages: DataFrame) -> DataFrame:
    """``disposition, n``; upserts and deletes are both emitted."""
    name = F.when(F.col("disposition").isin(*EMITTED), "emitted").otherwise(F.col("disposition"))
    return messages.groupBy(name.alias("disposition")).agg(F.count("*").alias("n"))


def counts_by_stream(messages: DataFrame, routes: Routes) -> DataFrame:
    """``stream, emitted`` for every stream, 0 for quiet ones."""
    known = messages.sparkSession.range(1).select(F.explode(F.array(*(F.lit(s.name) for s in routes.streams))).alias("stream"))
    found = messages.filter(F.col("disposition").isin(*EMITTED)).groupBy("stream").agg(F.count("*").alias("emitted"))
    return known.join(found, "stream", "left").select("stream", F.coalesce("emitted", F.lit(0)).alias("emitted"))


def max_lsn_seen(log: DataFrame) -> DataFrame:
    """Over all messages, also those that can't be read: they aren't read again."""
    return log.agg(F.max("lsn").alias("max_lsn"))


def emitted(messages: DataFrame, stream: StreamSpec) -> DataFrame:
    return messages.filter((F.col("stream") == stream.name) & F.col("disposition").isin(*EMITTED))


def quarantined(messages: DataFrame) -> DataFrame:
    """Messages that can't become rows, with the reason; they are passed for good, so keep them."""
    return messages.filter(F.col("disposition").isin(MALFORMED, QUARANTINED, UNKNOWN)).select("lsn", "payload", F.col("disposition").alias("reason"))
