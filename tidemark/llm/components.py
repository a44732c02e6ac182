"""Connected components of a link table: alternating large and small stars, or a forest on the driver where links are few.

Every step of the stars is a partial aggregation and a join on table rows, in which
ids of many links are dealt to many tasks; labels and links stay distributed, and
each round is a table in the shared folder.  A round is some ten shuffles whatever
the number of links, so up to DRIVER_LINKS of them, counted first, go to the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import salted, written

#: Most links that the driver joins: 8 MB of them.
DRIVER_LINKS = 1 << 19


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("w")), "least")
    return salted(both.filter("b > a"), least, ["a"], "w", ["b"]).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = written(down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("w")), "least")
    moved = salted(down, least, ["a"], "w", ["b"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def _is_done(e: DataFrame) -> bool:
    """Whether every id is either a centre or has one link, to a centre; links go to lesser ids, so centres are the least."""
    ends = e.select(F.col("a").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(e.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return not each.agg(F.max((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("in") == 1)))).first()[0]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the links and the least id that each reaches: roots hang on lesser ones until no link joins two."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while True:
        x, y = root[a], root[b]
        if np.array_equal(x, y):
            return ids, ids[root]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, up := root[root]):
            root = up


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``(id, component)``: each linked id with the least id it reaches.

    Ids without a link are absent; an empty link table gives an empty table.
    Star-shaped groups take one round, long chains about the logarithm of
    their length.
    """
    e = links.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a != b")
    if e.count() <= DRIVER_LINKS:
        got = e.toArrow()
        ids, least = _forest(*(got[c].to_numpy() for c in ("a", "b")))
        return written(links.sparkSession.createDataFrame(pa.table({"id": ids, "component": least})), "components")
    while True:
        e = written(_small_star(written(_large_star(e), "stars")), "stars")
        if _is_done(e):
            break
    return written(e.select(F.col("a").alias("id"), F.col("b").alias("component")).union(e.select("b", "b")).distinct(), "components")
