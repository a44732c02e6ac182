"""Mixing sources to target weights by hash-threshold histograms, in DataFrame expressions only.

Every document has a fixed 60-bit hash of its id.  A source's budget is met by
a threshold: documents of lower hash are taken.  Word counts are summed by
source and hash bucket; the bucket in which the budget ends is refined by the
next bits of the hash, and only documents of that bucket are read again, until
a bucket is a single hash.  No documents are sorted or collected, and a larger
budget takes a superset of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

#: Weights of sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Words wanted in all, over the words there are; and the most that a source may be repeated.
SHARE, MOST = 1.5, 2
#: Hash bits that each level of the histogram splits by; the last level has the rest of the 60.
BITS = (12, 12)


def _hash(doc_id: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: weighted shares, none above MOST times its size, the excess reshared by weight.

    Sources are levelled by size over weight: those below the level are filled
    to their most, the others share the rest.  One row a source; sources are the
    entries of a mix, a list that people keep, so one task orders them.
    """
    everything = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    named = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(everything) - 1) % len(WEIGHTS)) + 1))
    by_level = Window.partitionBy(F.lit(0)).orderBy((F.lit(float(MOST)) * F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    all_ = Window.partitionBy(F.lit(0))
    ranked = named.withColumns(
        {
            "i": F.row_number().over(by_level),
            "level": F.lit(float(MOST)) * F.col("source_size") / F.col("weight"),
            "filled": F.sum("source_size").over(by_level.rowsBetween(Window.unboundedPreceding, -1)),
            "rest": F.sum("weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
            "total": F.sum("source_size").over(all_),
        }
    )
    share = (F.lit(SHARE) * F.col("total") - F.lit(float(MOST)) * F.coalesce("filled", F.lit(0))) / F.col("rest")
    open_ = ranked.withColumn("share", share).withColumn("first", F.min(F.when(F.col("share") <= F.col("level"), F.col("i"))).over(all_))
    level = open_.withColumn("water", F.max(F.when(F.col("i") == F.col("first"), F.col("share"))).over(all_))
    return level.select("source", "source_size", F.when(F.col("i") < F.coalesce("first", F.lit(1 << 30)), F.lit(float(MOST)) * F.col("source_size")).otherwise(F.col("water") * F.col("weight")).alias("target"))


def _boundary(hist: DataFrame, budget: DataFrame) -> DataFrame:
    """For each source the bucket in which its budget ends, and the words of lower buckets."""
    w = Window.partitionBy("s").orderBy("bucket")
    run = hist.withColumn("upto", F.sum("words").over(w)).join(budget, "s")
    return run.filter("upto > budget - spent").groupBy("s").agg(F.min_by(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"), "words"), "bucket").alias("b")).select("s", "b.*")


def _size() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(common.WORD)).cast("long")


def _own() -> Column:
    """A hash that stands for the source's name: null needs no care with it."""
    return F.xxhash64(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))


def _cuts(slim: DataFrame, weight_rows: DataFrame | None) -> DataFrame:
    """``s, source_size, target, copies, threshold``: what the mix takes of each source."""
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weight_rows is not None:
        given = weight_rows.select(F.col("source").alias("ws"), F.col("target").cast("double").alias("target"))
        targets = sizes.join(given, F.expr("source <=> ws")).select("source", "source_size", "target")
    else:
        targets = _targets(sizes)
    plan = targets.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = common.written(plan.withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size")).withColumn("s", _own()), "plan")
    rows = slim.select(_own().alias("s"), "size", "h").filter("size > 0")

    state = plan.filter("budget > 0").select("s", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("spent"))
    left = 60
    for bits in (*BITS, 60 - sum(BITS)):
        before, left = left, left - bits
        inside = rows.join(common.checked_broadcast(state.select("s", "prefix"), 24), "s")
        if before < 60:
            inside = inside.filter(F.shiftright("h", before) == F.col("prefix"))
        hist = inside.groupBy("s", F.shiftright("h", left).alias("bucket")).agg(F.sum("size").alias("words"))
        found = _boundary(hist, state.select("s", "budget", "spent"))
        state = common.written(state.select("s", "budget", "spent").join(found, "s").select("s", "budget", F.col("bucket").alias("prefix"), (F.col("spent") + F.col("below")).alias("spent"), "words"), "level")
    near = F.col("spent") + F.col("words") - F.col("budget") < F.col("budget") - F.col("spent")
    cut = state.select("s", (F.col("prefix") + near.cast("long")).alias("threshold"))
    return common.written(plan.join(cut, "s", "left").select("s", "source_size", "target", "copies", F.coalesce("threshold", F.lit(0)).alias("threshold")), "cuts")


def _taken(copies: Column, h: Column, threshold: Column) -> Column:
    return F.least(copies + F.when(h < threshold, 1).otherwise(0), F.lit(MOST))


def mix(docs: DataFrame, weight_rows: DataFrame | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every document.

    ``taken`` is ``size`` times the copies the mix takes: as many whole copies
    of its source as the target holds, and one more of the documents whose hash
    is below the source's threshold.  The threshold is the one whose words come
    nearest to the target.  ``weight_rows(source, target)`` gives other targets,
    each at most MOST times its source's size.

    A null text has size 0; a null source is one source of its own.  Rows of
    equal id have equal hashes, null among them, so those of a source are taken
    together.  Empty documents and empty sources take 0; an empty table gives an
    empty one.  Other columns are ignored.
    """
    slim = common.written(docs.select("doc_id", "source", _size().alias("size"), _hash(F.col("doc_id")).alias("h")), "sizes")
    full = slim.withColumn("s", _own()).join(common.checked_broadcast(_cuts(slim, weight_rows), 48), "s")
    return full.select("doc_id", "size", "source_size", "target", (F.col("size") * _taken(F.col("copies"), F.col("h"), F.col("threshold"))).cast("long").alias("taken"))


def mixed(docs: DataFrame, weight_rows: DataFrame | None = None) -> DataFrame:
    """The documents of the mix with all their columns; those taken twice are there twice.

    Each row is taken by its own source, id and size, with nothing but a list of
    sources joined to it: repeated rows are taken each, rows of one id in
    two sources as their sources are, and texts without words never.  Null ids,
    texts and sources are as in ``mix``.  An empty table stays so; helper
    columns take names that the table doesn't have.
    """
    slim = docs.select("doc_id", "source", _size().alias("size"), _hash(F.col("doc_id")).alias("h"))
    cuts = _cuts(common.written(slim, "sizes"), weight_rows)
    s, copies, threshold, times = (common.free_name(docs, n) for n in ("mix_source", "mix_copies", "mix_threshold", "mix_times"))
    plan = cuts.select(F.col("s").alias(s), F.col("copies").alias(copies), F.col("threshold").alias(threshold))
    both = docs.withColumn(s, _own()).join(common.checked_broadcast(plan, 24), s)
    taken = F.when(_size() > 0, _taken(F.col(copies), _hash(F.col("doc_id")), F.col(threshold))).otherwise(0)
    return both.withColumn(times, F.explode(F.array_repeat(F.lit(1), taken.cast("int")))).select(common.columns_of(docs))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
      ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, 2.0::DOUBLE * source_size / weight AS level, row_number() OVER l AS i,
      coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
      sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest,
      sum(source_size) OVER () AS total FROM w WINDOW l AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)),
q AS (SELECT *, (1.5::DOUBLE * total::DOUBLE - 2.0::DOUBLE * filled::DOUBLE) / rest::DOUBLE AS share FROM r),
f AS (SELECT min(i) AS first FROM q WHERE share <= level),
t AS (SELECT source, source_size, CASE WHEN i < coalesce((SELECT first FROM f), 1073741824) THEN 2.0::DOUBLE * source_size
      ELSE (SELECT share FROM q WHERE i = (SELECT first FROM f)) * weight END AS target FROM q),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS copies FROM t),
x AS (SELECT p.source, h, sum(size) AS words, any_value(target - copies * source_size) AS budget FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source WHERE size > 0 GROUP BY p.source, h),
y AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) AS upto FROM x),
z AS (SELECT source, min(h) AS h FROM y WHERE budget > 0 AND upto > budget GROUP BY source),
c AS (SELECT y.source, CASE WHEN upto - budget < budget - (upto - words) THEN y.h + 1 ELSE y.h END AS threshold FROM y JOIN z ON y.source IS NOT DISTINCT FROM z.source AND y.h = z.h)
SELECT d.doc_id, d.size, p.source_size, p.target, (d.size * least(2, p.copies + CASE WHEN d.h < coalesce(c.threshold, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN c ON d.source IS NOT DISTINCT FROM c.source"""
