"""Whole rows from changes that don't carry all columns.

An update leaves out large values that didn't change, and a delete has its
identity only.  A column that is missing keeps the value of the key's last change
that had it; one that was set to null is null.  ``_present_cols`` tells them apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.identifiers import quoted
from tidemark.plans.catalog import LSN

PRESENT = "_present_cols"


def _held(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each column as a struct, null where the row doesn't have it."""
    return df.withColumns({f"_h{i}": F.when(F.array_contains(PRESENT, F.lit(c)), F.struct(quoted(c).alias("v"))) for i, c in enumerate(columns)})


def filled(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], folder: str, order: Sequence[str] = (LSN,)) -> DataFrame:
    """``changes`` with missing columns filled from the same key's last change before that had them, by ``order``; null if there is none.

    Changes lie in ranges of (key, order), so those of a key that has very many are in several tasks.  Each range is filled by
    itself; what it begins with comes from the ranges before it, of which only the last value of each key is needed.
    ``_present_cols`` is kept: it tells what a change itself has brought.  The ranges are written to ``folder``.
    """
    spark = changes.sparkSession
    names = changes.columns
    by = [*map(quoted, keys), *map(quoted, order)]
    ranged = _held(changes, columns).repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(folder)
    rows = spark.read.parquet(folder)
    held = [f"_h{i}" for i in range(len(columns))]
    within = Window.partitionBy("_range", *map(quoted, keys)).orderBy(*map(quoted, order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({h: F.last(h, ignorenulls=True).over(within) for h in held})
    # The last of each key in each range; and for a key in several ranges what each of them begins with.
    ends = spark.read.parquet(folder).groupBy("_range", *map(quoted, keys)).agg(*(F.max_by(h, F.when(F.col(h).isNotNull(), F.struct(*map(quoted, order)))).alias(h) for h in held))
    across = Window.partitionBy(*map(quoted, keys)).orderBy("_range")
    begins = ends.select("_range", *map(quoted, keys), F.count("*").over(Window.partitionBy(*map(quoted, keys))).alias("_n"), *(F.last(h, ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_b{h}") for h in held))
    begins = begins.filter("_n > 1").drop("_n").select(F.col("_range").alias("_at"), *(quoted(k).alias(f"_k{i}") for i, k in enumerate(keys)), *(f"_b{h}" for h in held))
    same = F.col("_range") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & quoted(k).eqNullSafe(F.col(f"_k{i}"))
    whole = rows.join(begins, same, "left")
    value = {c: F.coalesce(h, f"_b{h}")["v"] for c, h in zip(columns, held)}
    return whole.select(*(value[c].alias(c) if c in value else quoted(c) for c in names))


def latest(changes: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = (LSN,), deleted: str = "_sdc_deleted_at") -> DataFrame:
    """The row of each key as it stands behind all changes, without the deleted ones: by maxima, which are formed before the shuffle, so a key with very many changes is no burden.

    A delete ends a row: columns that a later insert doesn't carry aren't taken from before it.
    """
    held = _held(changes, columns)
    at = F.struct(*map(quoted, order))
    gone = F.max(F.when(quoted(deleted).isNotNull(), at)).alias("_gone")
    last = [F.max(F.when(F.col(f"_h{i}").isNotNull() & quoted(deleted).isNull(), F.struct(at.alias("at"), F.col(f"_h{i}").alias("h")))).alias(f"_l{i}") for i in range(len(columns))]
    found = held.groupBy(*map(quoted, keys)).agg(F.max(at).alias("_last"), gone, *last).filter("_gone IS NULL OR _last > _gone")
    return found.select(*map(quoted, keys), *(F.when(F.col("_gone").isNull() | (F.col(f"_l{i}.at") > F.col("_gone")), F.col(f"_l{i}.h.v")).alias(c) for i, c in enumerate(columns) if c not in keys))
