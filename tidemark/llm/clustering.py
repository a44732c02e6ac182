"""Centroid clustering by Lloyd's rounds with Drake's adaptive bounds.

Vectors become whole numbers, so distances, sums and ties are exact.  Each
vector keeps its centroid with an upper bound of the distance to it, several
more centroids with a lower bound each, and one lower bound for all the rest.
A round loosens the bounds by how far the centroids have moved.  A vector whose
upper bound stays below all lower ones keeps its centroid without a look at any;
where only some of the listed ones can be nearer, these are measured; where the
order can't be told from the bounds, all are.  Bounds are rounded outward and
compared strictly, so they never decide a tie.

A round is one pass over a table of vectors with their bounds: its tasks write
the vectors with new bounds, and one row a cluster and task with the sums, so
no vector is shuffled and only centroids are sent about.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, lean, scratch_path, shuffles_go

#: Components are multiplied by this and floored.
SCALE = 256
#: Up to here float products and their sums are exact; then 64-bit ones; beyond, Python's own.
EXACT_FLOAT, EXACT_LONG = 1 << 21, 1 << 27
#: Components from here on are refused: no distance to another vector would fit a long.
LARGEST = 1 << 62
#: Bounds are moved outward by this share for the rounding of roots and sums.
OUTWARD = 1e-12

_STATE = "vec_id long, vector binary, listed binary, bounds binary, cluster int, distance long, n long, used int, sums array<decimal(38,0)>"


def _whole(batch: pa.RecordBatch, dim: int) -> tuple[np.ndarray, pa.Array]:
    """The vectors that count, as whole numbers, and their ids."""
    ids, lists = batch.column(0), batch.column(1)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), -1))
    rows = np.flatnonzero(sizes == dim)
    flat = pa.compute.list_flatten(lists.take(pa.array(rows)))
    x = np.asarray(flat.cast(pa.float64()).to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, dim)
    missing = np.asarray(flat.is_null()).reshape(-1, dim).any(axis=1) if len(rows) else np.zeros(0, bool)
    fine = np.isfinite(x).all(axis=1) & ~missing
    x, rows = np.floor(x[fine] * SCALE), rows[fine]
    if len(x) and np.abs(x).max() >= LARGEST:
        raise OverflowError(f"components from {LARGEST // SCALE} on have no distance that fits a long")
    return x.astype(np.int64), ids.take(pa.array(rows))


def _packed(x: np.ndarray) -> pa.Array:
    """Vectors as bytes, two a component where all of a vector fit, else eight."""
    small = (np.abs(x) < 1 << 15).all(axis=1)
    if small.all():
        return pa.array([r.tobytes() for r in x.astype("<i2")], pa.binary())
    return pa.array([(r.astype("<i2") if s else r.astype("<i8")).tobytes() for r, s in zip(x, small)], pa.binary())


def _unpacked(column: pa.Array, dim: int) -> np.ndarray:
    raw = column.to_pylist()
    if all(len(r) == 2 * dim for r in raw):
        return np.frombuffer(b"".join(raw), dtype="<i2").reshape(-1, dim).astype(np.int64)
    return np.array([np.frombuffer(r, dtype="<i2" if len(r) == 2 * dim else "<i8") for r in raw], dtype=np.int64).reshape(-1, dim)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all rows of ``c``, or row by row where ``c`` has one more dimension."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if most <= EXACT_FLOAT and c.ndim == 2:
        f, g = x.astype(np.float64), c.astype(np.float64)
        return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)[None, :]).astype(np.int64)
    if most > EXACT_LONG:
        x, c = x.astype(object), c.astype(object)
    each = x[:, None, :] - (c[None, :, :] if c.ndim == 2 else c)
    return (each * each).sum(axis=2)


def _root(d: np.ndarray, up: bool) -> np.ndarray:
    return np.sqrt(d.astype(np.float64)) * (1 + OUTWARD if up else 1 - OUTWARD)


def _nearest(d: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places of a row's entries by distance, then by the centroid's number."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    return np.take_along_axis(by_id, np.argsort(np.take_along_axis(d, by_id, 1), axis=1, kind="stable"), 1)


class Bounds:
    """The bounds of a batch: ``ids[:, 0]`` is a vector's centroid, ``low[:, 0]`` an upper bound of that distance; the others are lower bounds, ``rest`` that of all not listed."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, rest: np.ndarray):
        self.ids, self.low, self.rest = ids, low, rest
        self.scans = self.partial = 0

    @classmethod
    def fresh(cls, x: np.ndarray, centroids: np.ndarray, places: int) -> Bounds:
        """By the distances to all centroids."""
        b = cls(np.zeros((len(x), places), np.int64), np.zeros((len(x), places)), np.zeros(len(x)))
        b._scan(x, centroids, np.arange(len(x)))
        return b

    def _scan(self, x: np.ndarray, centroids: np.ndarray, rows: np.ndarray) -> None:
        """Measures all centroids for some vectors."""
        if not len(rows):
            return
        self.scans += len(rows)
        places, k = self.ids.shape[1], len(centroids)
        d = squared(x[rows], centroids)
        order = np.argsort(d, axis=1, kind="stable")
        self.ids[rows] = order[:, :places]
        self.low[rows] = _root(np.take_along_axis(d, order[:, :places], 1), False)
        self.low[rows, 0] = _root(d[np.arange(len(rows)), order[:, 0]], True)
        self.rest[rows] = _root(d[np.arange(len(rows)), order[:, places]], False) if places < k else np.inf

    def loosen(self, drift: np.ndarray) -> None:
        """After centroids have moved by at most ``drift``."""
        first = (self.low[:, 0] + drift[self.ids[:, 0]]) * (1 + OUTWARD)
        self.low = (self.low - drift[self.ids]) - np.abs(self.low) * OUTWARD
        self.low[:, 0] = first
        self.rest = self.rest - drift.max(initial=0) * (1 + OUTWARD)
        self.rest -= np.abs(np.where(np.isfinite(self.rest), self.rest, 0)) * OUTWARD

    def assign(self, x: np.ndarray, centroids: np.ndarray) -> int:
        """Makes every vector's first entry its nearest centroid; how many places of the lists were needed at most."""
        others = np.minimum(self.low[:, 1:].min(axis=1, initial=np.inf), self.rest)
        open_ = np.flatnonzero(~(self.low[:, 0] < others))
        if not len(open_):
            return 1
        # The distance to a vector's own centroid first: often that is enough.
        own = squared(x[open_], centroids[self.ids[open_, :1]])[:, 0]
        self.low[open_, 0] = _root(own, True)
        open_ = open_[~(self.low[open_, 0] < others[open_])]
        near = open_[self.low[open_, 0] < self.rest[open_]]
        used = 1
        if len(near):
            self.partial += len(near)
            used = int((self.low[near, 1:] <= self.low[near, :1]).sum(axis=1).max(initial=0)) + 1
            ids = self.ids[near]
            d = squared(x[near], centroids[ids])
            order = _nearest(d, ids)
            self.ids[near] = np.take_along_axis(ids, order, 1)
            d = np.take_along_axis(d, order, 1)
            self.low[near] = _root(d, False)
            self.low[near, 0] = _root(d[:, 0], True)
        far = np.setdiff1d(open_, near, assume_unique=True)
        self._scan(x, centroids, far)
        return self.ids.shape[1] if len(far) else used

    def shorten(self, places: int) -> None:
        """Fewer places a vector; what falls out counts with the rest."""
        if places < self.ids.shape[1]:
            self.rest = np.minimum(self.rest, self.low[:, places:].min(axis=1))
            self.ids, self.low = self.ids[:, :places].copy(), self.low[:, :places].copy()


def _sums(x: np.ndarray, cluster: np.ndarray, into: dict[int, tuple[int, np.ndarray]]) -> None:
    """Adds a batch to the exact sums of clusters."""
    wide = np.abs(x).max(initial=0) > EXACT_LONG
    for c in np.unique(cluster):
        rows = x[cluster == c]
        n, total = into.get(int(c), (0, np.zeros(x.shape[1], dtype=object)))
        into[int(c)] = n + len(rows), total + (rows.astype(object) if wide else rows).sum(axis=0).astype(object)


def _pass(centroids: np.ndarray, drift: np.ndarray | None, places: int, dim: int, last: bool):
    """A round's work in a task: with ``drift`` from the table of bounds, without from the vectors themselves."""
    schema = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("listed", pa.binary()), ("bounds", pa.binary()), ("cluster", pa.int32()), ("distance", pa.int64()), ("n", pa.int64()), ("used", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])

    def rows(ids: pa.Array, x: np.ndarray, b: Bounds) -> pa.RecordBatch:
        n = len(x)
        none = lambda kind: pa.nulls(n, kind)
        cluster = pa.array(b.ids[:, 0].astype(np.int32))
        if last:
            d = squared(x, centroids[b.ids[:, :1]])[:, 0]
            if n and max(d) >= 1 << 63:
                raise OverflowError("a distance that doesn't fit a long")
            return pa.RecordBatch.from_arrays([ids, none(pa.binary()), none(pa.binary()), none(pa.binary()), cluster, pa.array([int(v) for v in d], pa.int64()), none(pa.int64()), none(pa.int32()), none(schema.field("sums").type)], schema=schema)
        listed = pa.array([r.tobytes() for r in b.ids.astype("<u2")], pa.binary())
        bounds = pa.array([r.tobytes() for r in np.column_stack([b.low, b.rest]).astype("<f8")], pa.binary())
        return pa.RecordBatch.from_arrays([ids, _packed(x), listed, bounds, cluster, none(pa.int64()), none(pa.int64()), none(pa.int32()), none(schema.field("sums").type)], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        used = 1
        for batch in batches:
            if drift is None:
                x, ids = _whole(batch, dim)
                b = Bounds.fresh(x, centroids, places) if len(x) else None
            elif batch.num_rows:
                ids, x = batch.column(0), _unpacked(batch.column(1), dim)
                n = len(x)
                listed = np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype="<u2").reshape(n, -1).astype(np.int64)
                bounds = np.frombuffer(b"".join(batch.column(3).to_pylist()), dtype="<f8").reshape(n, -1)
                b = Bounds(listed, bounds[:, :-1].copy(), bounds[:, -1].copy())
                b.shorten(places)
                b.loosen(drift)
                used = max(used, b.assign(x, centroids))
            else:
                continue
            if b is not None and len(x):
                if not last:
                    _sums(x, b.ids[:, 0], sums)
                yield rows(ids, x, b)
        if sums:
            m = len(sums)
            none = lambda kind: pa.nulls(m, kind)
            totals = [[int(v) for v in total] for _, total in sums.values()]
            yield pa.RecordBatch.from_arrays(
                [none(pa.int64()), none(pa.binary()), none(pa.binary()), none(pa.binary()), pa.array(list(sums), pa.int32()), none(pa.int64()), pa.array([n for n, _ in sums.values()], pa.int64()), pa.array([used] * m, pa.int32()), pa.array(totals, schema.field("sums").type)],
                schema=schema,
            )

    return lean(work)


def _ceil_root(d: int) -> float:
    return float(np.sqrt(float(d))) * (1 + OUTWARD)


def drifts(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each centroid has moved, at most."""
    return np.array([_ceil_root(sum((int(a) - int(b)) ** 2 for a, b in zip(o, n))) for o, n in zip(old, new)])


def centroid_digest(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest()


def clusters(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector of ``vec_id, embedding`` that has
    exactly ``dim`` components, none null or non-finite; others aren't returned.

    Components count as ``floor(256 * x)``.  The first centroids are the ``k`` vectors of least sha256 of ``seed:vec_id``; of
    equal ids the vector that is less by its components comes first, and vectors without an id start no cluster, but are assigned
    and returned.  With fewer vectors than ``k`` all are centroids.  Each round assigns all vectors to the nearest centroid (ties: the
    smaller number) and moves each non-empty centroid to the floor of its vectors' mean; then all are assigned once more.  Rows that
    repeat count each.  No vectors give no rows.  Columns beside the two are left aside, whatever their names.
    """
    spark = vectors.sparkSession
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fit = (F.size("embedding") == dim) & ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = source.filter(fit & F.col("vec_id").isNotNull()).select(order.alias("_order"), F.transform("embedding", lambda v: F.floor(v * SCALE).cast("long")).alias("whole")).orderBy("_order", "whole").limit(k)
    centroids = np.array([r["whole"] for r in first.collect()], dtype=np.int64).reshape(-1, dim)
    names = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], names)
    k = len(centroids)
    # Drake's numbers of places: a quarter of the centroids at first, never under an eighth.
    places, least = min(k, max(2, k // 4 + 1)), min(k, max(2, k // 8 + 1))
    table: DataFrame | None = None
    drift: np.ndarray | None = None
    for turn in range(rounds + 1):
        last = turn == rounds
        work = _pass(centroids, drift, places, dim, last)
        path = scratch_path(spark, "clusters")
        rows = (source if table is None else table.filter("vector IS NOT NULL").select("vec_id", "vector", "listed", "bounds")).mapInArrow(work, _STATE)
        with shuffles_go(spark):
            rows.write.parquet(path)
        old, table = table, spark.read.schema(_STATE).parquet(path)
        if old is not None:
            discard(old)
        if last:
            break
        totals = table.filter("sums IS NOT NULL").select("cluster", "n", "used", *(F.col("sums")[i].alias(f"s{i}") for i in range(dim)))
        found = totals.groupBy("cluster").agg(F.sum("n").alias("n"), F.max("used").alias("used"), *(F.sum(f"s{i}").alias(f"s{i}") for i in range(dim))).collect()
        moved = centroids.copy()
        for r in found:
            moved[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(dim)]
        if turn:
            places = max(least, min(places, max((r["used"] for r in found), default=places) + 1))
        centroids, drift = moved, drifts(centroids, moved)
    rows = table.select("vec_id", "cluster", "distance")
    inertia = rows.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()
    total = sum(r["sum"] for r in inertia)
    by = spark.createDataFrame([(r["cluster"], r["sum"], total, centroid_digest(centroids[r["cluster"]])) for r in inertia], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(by), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2) -> str:
    """Plain rounds over all pairs of vectors and centroids, in DuckDB SQL."""
    steps = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS w FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dim})",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), w) - 1)::INTEGER AS c, w FROM v WHERE vec_id IS NOT NULL ORDER BY sha256('{seed}:' || vec_id), w LIMIT {k})",
    ]
    apart = "list_sum(list_transform(list_zip(v.w, c.w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT v.row, min(struct_pack(d := {apart}, c := c.c)) AS best FROM v, c{i} c GROUP BY v.row)")
        if i < rounds:
            steps.append(f"m{i} AS MATERIALIZED (SELECT a.best.c AS c, i, floor(sum(v.w[i])::DOUBLE / count(*))::BIGINT AS x FROM a{i} a JOIN v USING (row), range(1, {dim + 1}) r(i) GROUP BY 1, 2)")
            steps.append(f"n{i} AS MATERIALIZED (SELECT c, list(x ORDER BY i) AS w FROM m{i} GROUP BY c)")
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(n.w, o.w) AS w FROM c{i} o LEFT JOIN n{i} n ON n.c = o.c)")
    return f"""WITH {", ".join(steps)}
SELECT v.vec_id, a.best.c AS cluster, a.best.d AS distance, (sum(a.best.d) OVER (PARTITION BY a.best.c))::BIGINT AS cluster_inertia, (sum(a.best.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.w, ',')) AS centroid_sha256 FROM v JOIN a{rounds} a USING (row) JOIN c{rounds} c ON c.c = a.best.c"""
