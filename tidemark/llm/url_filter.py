"""URL filters by a temporal list join, in DataFrame expressions only.

Dated list entries (add, remove) become validity intervals.  Every capture is
looked up by its host, the host's parent domains and its path prefixes, as of
the moment it was fetched: an equality join on the pattern with the interval as
a condition, so there is no sort by time and no join of all captures of a host
with each other.  The list side is broadcast only if its size allows.  Else a
bitmap of the patterns sorts out most lookups, both sides are shuffled, and the
captures of a hot host or domain are dealt to many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

_HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(\[[0-9a-f:.]+\]|[^/?#:\[]+)"
#: Hosts that are addresses: their labels are no domains.
_ADDRESS = r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$"
_PATH = r"^[^:/?#]+://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.rtrim(F.regexp_extract(F.lower(F.coalesce(url, F.lit(""))), _HOST, 1), F.lit("."))


def intervals(entries: DataFrame) -> DataFrame:
    """``list, pattern, since, until``: when a pattern was on a list; ``until`` is null while it still is.

    Entries are (list, pattern, action, date).  Of several on one date a remove
    comes last.  A repeated add changes nothing, nor does a remove of what isn't
    on the list.  Entries with a null pattern, action or date are left out.
    Hosts are the same in any case, paths only in their own.
    """
    host = F.substring_index("pattern", "/", 1)
    same = F.concat(F.lower(host), F.col("pattern").substr(F.length(host) + 1, F.length("pattern")))
    kept = entries.filter("pattern is not null and date is not null and action in ('add', 'remove')").select(F.coalesce("list", F.lit("")).alias("list"), same.alias("pattern"), "action", "date")
    days = kept.groupBy("list", "pattern", "date").agg(F.max("action").alias("action"))
    w = Window.partitionBy("list", "pattern").orderBy("date")
    turns = days.withColumn("was", F.lag("action").over(w)).filter("was is null or was != action")
    return turns.withColumn("until", F.lead("date").over(w)).filter("action = 'add'").select("list", "pattern", F.col("date").alias("since"), "until")


def lookup_keys(host: Column, path: Column, depth: Column) -> Column:
    """Patterns that may match: the host, its parent domains down to two labels (an address has none), and path prefixes to a depth."""
    labels = F.split(host, "\\.")
    last = F.when(host.rlike(_ADDRESS), 1).otherwise(F.greatest(F.size(labels) - 1, F.lit(1)))
    domains = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    deep = F.least(F.size(parts), depth)
    paths = F.when(deep > 0, F.transform(F.sequence(F.lit(1), F.greatest(deep, F.lit(1))), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))))
    return F.array_distinct(F.concat(domains, F.coalesce(paths, F.array().cast("array<string>"))))


def _looked_up(probes: DataFrame, known: DataFrame) -> DataFrame:
    """Probes with the intervals of their pattern."""
    if common.small_enough(known, 96):
        return probes.join(F.broadcast(known), "pattern")
    marked = known.select(F.xxhash64("pattern").alias("hash")).distinct()
    near = common.may_be_in(probes.withColumn("hash", F.xxhash64("pattern")), "hash", common.bitmap(marked, "hash")).drop("hash")
    near = common.written(near, "probes")
    counts = common.written(near.groupBy("pattern").agg(F.count("*").alias("w")), "counts")
    return common.salted(near, known.join(counts.hint("merge"), "pattern"), ["pattern"], "w", ["page_id", "url", "fetched"], counts=counts)


def url_filter(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``page_id, url, fetched, host, n_active, blocked, list, pattern, since`` for every capture (page_id, url, fetched).

    ``n_active`` counts list entries that match and were active on the day of
    the fetch: since <= fetched < until.  ``list, pattern, since`` are those of
    the longest pattern, then of the first list.  A null or unreadable url, or a
    null date, matches nothing.  Rows of one id are one capture each.  An empty
    table on either side gives no captures or no matches; other columns are
    ignored.
    """
    known = common.written(intervals(entries), "intervals")
    depth = known.agg(F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0))).first()[0]
    seen = captures.select("page_id", "url", "fetched", host_of(F.col("url")).alias("host"))
    keys = lookup_keys(F.col("host"), F.regexp_extract(F.coalesce("url", F.lit("")), _PATH, 1), F.lit(depth))
    probes = seen.filter("host != '' and fetched is not null").select("page_id", "url", "fetched", F.explode(keys).alias("pattern"))
    active = _looked_up(probes.distinct(), known).filter("since <= fetched and (until is null or fetched < until)")
    first = F.min_by(F.struct("list", "pattern", "since"), F.struct(-F.length("pattern"), F.col("list"), F.col("pattern")))
    hits = active.groupBy("page_id", "url", "fetched").agg(F.count("*").alias("n_active"), first.alias("rule"))
    same = F.expr("page_id <=> hit_id and url <=> hit_url and fetched <=> hit_fetched")
    hits = common.written(hits.select(F.col("page_id").alias("hit_id"), F.col("url").alias("hit_url"), F.col("fetched").alias("hit_fetched"), "n_active", "rule"), "hits")
    joined = seen.join(hits, same, "left")
    return joined.select("page_id", "url", "fetched", "host", F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("n_active").isNotNull().alias("blocked"), "rule.list", "rule.pattern", "rule.since")
