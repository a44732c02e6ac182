"""Document fingerprints: a quartile bucket digest, and how alike two digests are.

The bytes of a text (UTF-8) are read by a window of five.  Each place gives the
six triplets of its newest byte with two of the four before it; each triplet is
hashed to a bucket, the six kinds apart.  A digest holds, for each bucket, the
quartile that its count lies in, and the length of the text in steps of an
eighth of a doubling.  Two digests differ by the distances of their
buckets' quartiles and by their lengths, which is bounded, so likeness is a
number from 0 to 1.

Zero bytes before a text give short texts triplets too, so that texts of a few
letters have digests of their own; only an empty text has none.

The query's edited texts need a document's follower by id.  Documents are dealt
to ranges of ids, each sorted and read as a stream in which a document meets its
follower; what stands at the ends of ranges is paired by a small table of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import SLICE_BYTES, lean, scratch_path, short_batches, shuffles_go

BUCKETS = 128
#: Offsets back from the newest byte; each pair makes a kind of triplet of its own.
PAIRS = ((1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4))
WINDOW = 5
#: A bucket's difference by the distance of its quartiles.
STEPS = (0, 1, 2, 3)
#: A length step's difference, and the most that lengths may add.
LENGTH_STEP, LENGTH_MOST = 4, 128
#: Steps of length for a doubling.
PER_DOUBLING = 8
_MULTIPLIERS = tuple((2 * i + 1) * 0x9E3779B1 & 0xFFFFFFFF for i in range(1, 4 * len(PAIRS), 4))
_SHIFT = 32 - (BUCKETS.bit_length() - 1)


def bucket(newest: int, b: int, c: int, kind: int) -> int:
    """The bucket of one triplet."""
    x = (newest << 16 | b << 8 | c) + 1
    x = x * _MULTIPLIERS[kind] & 0xFFFFFFFF
    x = (x ^ x >> 15) * 0x85EBCA6B & 0xFFFFFFFF
    return x >> _SHIFT


def bucket_counts(data: bytes, slice_bytes: int = SLICE_BYTES) -> np.ndarray:
    """How many triplets each bucket has; long texts are counted in slices that overlap by a window."""
    counts = np.zeros(BUCKETS, dtype=np.int64)
    if not data:
        return counts
    raw = np.frombuffer(bytes(WINDOW - 1) + data, dtype=np.uint8)
    for lo in range(0, len(data), slice_bytes):
        part = raw[lo : lo + slice_bytes + WINDOW - 1].astype(np.uint32)
        newest = part[WINDOW - 1 :] << np.uint32(16)
        at = lambda back: part[WINDOW - 1 - back : len(part) - back]
        for kind, (i, j) in enumerate(PAIRS):
            x = ((newest | at(i) << np.uint32(8) | at(j)) + np.uint32(1)) * np.uint32(_MULTIPLIERS[kind])
            x = (x ^ x >> np.uint32(15)) * np.uint32(0x85EBCA6B)
            counts += np.bincount(x >> np.uint32(_SHIFT), minlength=BUCKETS)
    return counts


def length_code(n: int) -> int:
    """The length in steps of an eighth of a doubling, 0 for none; whole-number arithmetic, so it is the same everywhere."""
    if not n:
        return 0
    whole = n.bit_length() - 1
    return min(255, 1 + whole * PER_DOUBLING + ((n << PER_DOUBLING.bit_length() - 1 >> whole) - PER_DOUBLING))


def fingerprint(data: bytes) -> str:
    """Hex: a byte of length, then two bits a bucket, 0 for counts up to the first quartile to 3 for those beyond the third."""
    counts = bucket_counts(data)
    ranked = np.sort(counts)
    q1, q2, q3 = (ranked[BUCKETS * i // 4 - 1] for i in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    four = codes.reshape(-1, 4)
    return (bytes([length_code(len(data))]) + (four[:, 0] << 6 | four[:, 1] << 4 | four[:, 2] << 2 | four[:, 3]).astype(np.uint8).tobytes()).hex()


_APART = np.array([[sum(STEPS[abs((a >> s & 3) - (b >> s & 3))] for s in (0, 2, 4, 6)) for b in range(256)] for a in range(256)], dtype=np.int64)
MOST = BUCKETS * STEPS[3] + LENGTH_MOST


def difference(a: str, b: str) -> int:
    """From 0 to MOST."""
    x, y = (np.frombuffer(bytes.fromhex(f), dtype=np.uint8) for f in (a, b))
    length = min(LENGTH_MOST, LENGTH_STEP * abs(int(x[0]) - int(y[0])))
    return int(_APART[x[1:], y[1:]].sum()) + length


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, 0 for those that differ as much as any can."""
    return 1 - difference(a, b) / MOST


def edited(text: str, follower: str) -> str:
    """The last half of a text's code points, rounded down, give way to as many first ones of another's, or all that it has."""
    half = len(text) // 2
    return text[: len(text) - half] + follower[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` and ``fingerprint`` of its whole ``text`` (null: empty); a column of that name is replaced."""
    short_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != "fingerprint"]
    rows = docs.select(*(F.col("`" + c.replace("`", "``") + "`") for c in kept))
    at = next(i for i, c in enumerate(kept) if c.lower() == "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((v.as_py() or "").encode()) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*kept, "fingerprint"])

    return rows.mapInArrow(lean(work), T.StructType([*rows.schema.fields, T.StructField("fingerprint", T.StringType())]))


_ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
_EDGE = [("part", pa.int64()), ("edge", pa.string()), ("text", pa.string())]


class _Document:
    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        self.print = fingerprint(self.text.encode())

    def before(self, follower: _Document) -> tuple:
        """The row of this document, by the one that follows it."""
        new = edited(self.text, follower.text)
        data = new.encode()
        other = fingerprint(data)
        return (self.doc_id, len(self.text), hashlib.sha256(data).hexdigest(), self.print, other, likeness(self.print, other), likeness(self.print, follower.print))


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of documents whose follower is in the same range, and the range's first and last document."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([*_ARROW, *_EDGE])
    edge = lambda d, which: (d.doc_id, *[None] * (len(_ARROW) - 1), part, which, d.text)
    before = None
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            d = _Document(batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
            out.append(edge(d, "first") if before is None else (*before.before(d), None, None, None))
            before = d
        if out:
            yield _emit(out, schema)
    if before is not None:
        yield _emit([edge(before, "last")], schema)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            doc_id, text, follower = (batch.column(j)[i].as_py() for j in range(3))
            yield _emit([_Document(doc_id, text).before(_Document(None, follower))], _ARROW)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` of every row of ``doc_id, text``.

    A document's edited text ends in the beginning of the next document's, ascending by id, after the last the first; its
    likenesses are those to the edited text and to the next document. Null ids come first; rows of one id go by their text's
    md5; rows that repeat follow each other. A single document follows itself. Null texts are empty. No documents give no
    rows. Rows that agree in id and text stay in one task, one after the other.
    """
    spark = docs.sparkSession
    short_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("_hash", F.md5("text"))
    ranged = rows.repartitionByRange(F.col("doc_id"), F.col("_hash")).sortWithinPartitions("doc_id", "_hash").select("doc_id", "text")
    path = scratch_path(spark, "fingerprints")
    with shuffles_go(spark):
        ranged.mapInArrow(lean(_ranges), f"{_ROW}, part long, edge string, text string").write.partitionBy("edge").parquet(path)
    schema = f"{_ROW}, part long, text string, edge string"
    made = spark.read.schema(schema).parquet(path)
    # Two rows a range, by number alone; the ranges' texts are joined to them.
    ends = made.filter("edge IS NOT NULL").select("part", "edge", "doc_id", "text")
    order = Window.orderBy("part")
    parts = ends.filter("edge = 'last'").select("part").withColumn("_next", F.coalesce(F.lead("part").over(order), F.min("part").over(Window.partitionBy())))
    pairs = ends.filter("edge = 'last'").join(parts, "part").join(ends.filter("edge = 'first'").select(F.col("part").alias("_next"), F.col("text").alias("follower")), "_next")
    closed = pairs.select("doc_id", "text", "follower").mapInArrow(lean(_pairs), _ROW)
    return made.filter("edge IS NULL").select(*(f.name for f in closed.schema.fields)).unionByName(closed)
