"""What the operators share: scratch tables, size-checked joins, word hashing.

Scratch tables go to the folder that the cluster names in
``spark.checkpoint.dir`` (every executor sees it) and are deleted when the
driver's file system closes.  Nothing here keeps state on an executor's disk.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Largest id list, in bytes, that may be broadcast; above it a shuffle join is used.
BROADCAST_BYTES = 32 << 20
#: Text bytes hashed at once: bounds the arrays a Python worker holds.
SLICE_BYTES = 1 << 20
#: Words, or hashes, that are worked on at once.
SLICE_WORDS = 1 << 17
#: Rows and bytes that Spark hands a Python worker at once where the session has its defaults: texts are long.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: A key of more rows than this is dealt to several tasks by ``salted``, unless very many keys are that large.
KEY_ROWS = 256
#: ``salted`` broadcasts at most so many large keys.
LARGE_KEYS = 1 << 16
#: Spark's setting by which a query's shuffle files are deleted when it ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Words of 64 bits that a ``bitmap`` has at most.
BITMAP_WORDS = 1 << 22


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of this application. A local session may do without (tests); its folder is a temporary one."""
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not jvm_dir.isDefined() and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
        root = jvm_dir.get() if jvm_dir.isDefined() else tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tidemark-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that is made in here go with its end, and don't wait for the driver's garbage collection."""
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, and losing an executor loses nothing.

    The shuffle files of the write go with its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_go(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            remove(table.sparkSession, folder)


def short_batches(spark: SparkSession) -> None:
    """Keeps batches of texts small, so that a worker's memory stays so; a session's own settings are left alone."""
    for name, default, value in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if str(spark.conf.get(name, default)).lower() in (default, "64mb"):
            spark.conf.set(name, str(value))


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on after its task, and else keeps the most it ever had."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches, after which the worker gives its memory back."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def small_enough(df: DataFrame, row_bytes: int = 16, limit: int = BROADCAST_BYTES) -> bool:
    """Counts a written table to see whether it may be broadcast."""
    return df.count() * row_bytes <= limit


def checked_broadcast(df: DataFrame, row_bytes: int = 16) -> DataFrame:
    """A broadcast hint below the limit; else the table as it is, and Spark shuffles both sides."""
    return F.broadcast(df) if small_enough(df, row_bytes) else df


def salted(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str, by: Sequence[str | Column], how: str = "inner", counts: DataFrame | None = None, known: bool = False) -> DataFrame:
    """``left`` joined with ``right`` on equal keys by a shuffle of both; large keys are dealt to many tasks.

    ``right`` has one row a key, with the number of its left rows as ``weight``,
    which is dropped.  A key of more than KEY_ROWS of them has its row copied to
    as many parts as it takes, and its left rows are dealt by ``by``.  Such keys
    are listed to all tasks: LARGE_KEYS at most, for the limit rises with the
    number of rows; with ``known``, the left rows have the weight too and no list
    is needed.  ``counts`` has keys and weights alone where ``right`` is not a
    written table; if ``right`` has no weights then, the list serves it too.
    """
    salt = free_name(left, "_salt")
    size = lambda part: F.greatest(F.ceil(F.col(weight) / part), F.lit(1)).cast("int")
    dealt = lambda parts: F.when(parts > 1, F.pmod(F.xxhash64(*by), parts).cast("int")).otherwise(0)
    if known:
        part = KEY_ROWS
        left = left.withColumn(salt, dealt(size(part))).drop(weight)
    else:
        weights = right if counts is None else counts
        total = weights.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
        part = max(KEY_ROWS, total // LARGE_KEYS + 1)
        parts = free_name(left, "_parts")
        large = weights.filter(F.col(weight) > part).select(*on, size(part).alias(parts))
        # A row that matches nothing: the plan is the same whether there are large keys or not.
        none = left.sparkSession.range(1).select(*(F.lit(None).cast(weights.schema[c].dataType).alias(c) for c in on), F.lit(1).alias(parts))
        large = F.broadcast(large.union(none))
        left = left.join(large, list(on), "left").withColumn(salt, dealt(F.coalesce(parts, F.lit(1)))).drop(parts)
    if known or weight in right.columns:
        copied = right.withColumn(salt, F.explode(F.sequence(F.lit(0), size(part) - 1))).drop(weight)
    else:
        copied = right.join(large, list(on), "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(parts, F.lit(1)) - 1))).drop(parts)
    return left.join(copied.hint("merge"), [*on, salt], how).drop(salt)


def _bit(key: Column, words: int) -> tuple[Column, Column]:
    """The word of a bitmap that a 64-bit hash belongs to, and the value of its bit."""
    return key.bitwiseAND(F.lit(words - 1).cast("long")), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(key, 58).cast("int"))


def bitmap(keys: DataFrame, column: str, most: int = BITMAP_WORDS) -> tuple[DataFrame, int]:
    """A set of 64-bit hashes as a written table ``_word, _bits`` of bounded size, and its number of words.

    About four hashes share a word until the bound is reached.  Whatever the
    number of hashes, ``may_be_in`` never misses one; beyond the bound it only
    lets more others through.
    """
    words = 1 << min(most.bit_length() - 1, max(10, (keys.count() // 4).bit_length()))
    word, bit = _bit(F.col(column), words)
    return written(keys.groupBy(word.alias("_word")).agg(F.bit_or(bit).alias("_bits")), "bitmap"), words


def _looked_up(rows: DataFrame, column: str, bits: tuple[DataFrame, int], how: str, wanted: bool) -> DataFrame:
    table, words = bits
    at, have = free_name(rows, "_word"), free_name(rows, "_bits")
    word, bit = _bit(F.col(column), words)
    joined = rows.withColumn(at, word).join(F.broadcast(table.toDF(at, have)), at, how)
    hit = F.coalesce(F.col(have).bitwiseAND(bit) != 0, F.lit(False))
    return joined.filter(hit if wanted else ~hit).drop(at, have)


def may_be_in(rows: DataFrame, column: str, bits: tuple[DataFrame, int]) -> DataFrame:
    """The rows whose hash is in a bitmap, and a few others: no shuffle, the bitmap is broadcast."""
    return _looked_up(rows, column, bits, "inner", True)


def not_in(rows: DataFrame, column: str, bits: tuple[DataFrame, int]) -> DataFrame:
    """The rows that ``may_be_in`` leaves out; a null hash is among them."""
    return _looked_up(rows, column, bits, "left", False)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever their names."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def row_key() -> tuple[Column, Column]:
    """96 bits of hash of a document's id and text, null or not: rows that agree in them are taken as repeated."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    both = (doc_id.isNull(), doc_id, text.isNull(), text)
    return F.xxhash64(*both), F.hash(*both)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, whatever its case."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def text_slices(batch: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes each, one row at least."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch), 0), dtype=np.int64)
    if not len(sizes):
        return
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(sizes):
        base = ends[lo] - sizes[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield lo, hi
        lo = hi


def string_bytes(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array, and its n+1 offsets into them. Null counts as empty."""
    if arr.null_count:
        arr = pa.compute.fill_null(arr, "")
    arr = arr.cast(pa.large_string()) if not pa.types.is_large_string(arr.type) else arr
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset : arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, dtype=np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return raw, offsets - lo


_WS = np.zeros(256, dtype=bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    have = _powers.get(which)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 16), _B if which == "up" else _B_INV, dtype=np.uint64)
        step[0] = 1
        have = _powers[which] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _WS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in the bytes, and for n texts n+1 positions in those lists. ``apart``: bytes between words."""
    if not len(raw):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    solid = ~apart[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate(([False], solid))
    after = np.concatenate((solid, [False]))
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, A-Z lowered first if asked for."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    table = _TABLE[_LOWER] if lower else _TABLE
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(table[raw] * _power("up", len(raw)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power("down", len(raw))[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def _long_word(raw: np.ndarray, lower: bool, limit: int) -> np.uint64:
    """``word_hashes`` of bytes that are one word, whatever its length."""
    table, mask = _TABLE[_LOWER] if lower else _TABLE, (1 << 64) - 1
    total, scale = 0, 1
    for lo in range(0, len(raw), limit):
        part = raw[lo : lo + limit]
        total += int(np.sum(table[part] * _power("up", len(part)), dtype=np.uint64)) * scale
        scale = scale * pow(int(_B), len(part), 1 << 64) & mask
    return mix(np.array([(total + len(raw)) & mask], dtype=np.uint64))[0]


def hashed_words(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = _WS, lower: bool = True, limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in the bytes, and for n texts n+1 positions in them.

    The bytes are taken in slices that end between words, a word that is longer
    than a slice by itself: beside the hashes, memory doesn't grow with a text.
    """
    n, lo = len(raw), 0
    parts, at = [np.zeros(0, np.uint64)], np.zeros(len(offsets), dtype=np.int64)
    while lo < n:
        hi = min(n, lo + limit)
        if hi < n:
            gaps = np.flatnonzero(apart[raw[lo:hi]])
            edge = int(offsets[np.searchsorted(offsets, hi, side="right") - 1])
            cut = max(lo + int(gaps[-1]) + 1 if len(gaps) else lo, edge)
            if cut <= lo:
                stop = int(offsets[np.searchsorted(offsets, lo, side="right")])
                while hi < stop and not apart[raw[hi : min(hi + limit, stop)]].any():
                    hi = min(hi + limit, stop)
                if hi < stop:
                    hi += int(np.argmax(apart[raw[hi : min(hi + limit, stop)]]))
                parts.append(np.array([_long_word(raw[lo:hi], lower, limit)], dtype=np.uint64))
                at += offsets > lo
                lo = hi
                continue
            hi = cut
        inside = offsets[np.searchsorted(offsets, lo) : np.searchsorted(offsets, hi, side="right")] - lo
        starts, ends, _ = word_spans(raw[lo:hi], inside, apart)
        parts.append(word_hashes(raw[lo:hi], starts, ends, lower))
        at += np.searchsorted(starts + lo, offsets)
        lo = hi
    return np.concatenate(parts), at


def run_hashes(words: np.ndarray, form: Sequence[int], factor: int) -> np.ndarray:
    """Hashes of the words at the places of a form, counted from each word on at which it fits; in slices, as ``hashed_words``."""
    out = np.empty(max(0, len(words) - form[-1]), dtype=np.uint64)
    for lo in range(0, len(out), SLICE_WORDS):
        hi = min(len(out), lo + SLICE_WORDS)
        h = np.full(hi - lo, len(form), dtype=np.uint64)
        for j in form:
            h *= np.uint64(factor)
            h += words[lo + j : hi + j]
            h ^= h >> np.uint64(32)
        out[lo:hi] = mix(h)
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles in order; fewer than k words make one; no words make none."""
    return run_hashes(words, range(min(k, len(words))), 0xD6E8FEB86659FD93) if len(words) else words
