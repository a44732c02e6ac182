"""N-gram Jaccard join by parity sketches.

A text's distinct k-word shingles are toggled into a sparse bit sketch, one bit
a shingle.  Two sketches differ in at most as many bits as the sets have
shingles in their symmetric difference.  At a Jaccard similarity of t that
difference is at most (1-t)/(1+t) of the summed sizes, so when the sketch is
cut into more blocks than that, some blocks are equal.  Sizes of linked sets
differ by a factor 1/t at most, so with size bands of at least that ratio a set
meets its partners in its own band or the next one.  Bands are twice as wide (in
logarithms): only the upper half of a band has keys in the next one too.

* A block's key is the XOR of the mixed positions of its toggled bits.
* Blocks beyond the bound are slack: so many of its empty and very common blocks,
  the first in an order that all sets share, need not bring a set together with
  others.  Of linked sets more blocks are equal; the last of those in that order
  is left out by neither set.
* Keys are aggregated to (least, greatest set), which combines before the
  shuffle: nearly all have one.  A bitmap of the others is probed by all keys
  again, so that only those few are shuffled with their classes.
* Texts that nearly link share many keys.  Of the keys in which the very same
  classes meet, one stands for all, with their number.  Common keys in which
  nearly the same classes meet are compared as one key of all their classes.
* A class is compared with the least class of its keys first (a star), so
  copies cost one comparison each.  Only pairs whose dense sketches are near
  have their texts fetched.
* Where a key still spans several components, its classes' dense sketches are
  compared, and a spanning forest of the near ones is verified; then, between
  the components that are left, every near pair.  No pair within a component is
  looked at again, so the links found are little more than a spanning forest:
  the result is components, not the join's pairs or their number.
* Candidates are verified on whole texts with exact integer arithmetic.

Texts with equal shingle sets form one class: 128 bits of hash and the size.
Large classes, keys, stars and components are dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.components import components

#: Keys met by more classes than this are common; after the first star, sets skip as many of them as they have slack left.
COMMON_KEY = 64
#: Rows of one key, and their shingles, that a task compares with each other; a larger key is dealt to pairs of such parts.
BUCKET, BUCKET_WORDS = 1024, 16 << 20
#: Parts of the key space that are shuffled one after the other.
SLICES = 3
#: Near pairs that a task hands on at once.
OUTPUT = 1 << 16


def size_bands(limit: int, percent: int) -> list[int]:
    """Band starts 1 = B0 < B1 < ...: sizes linkable at ``percent`` lie in one band or neighbours."""
    b = [1]
    while b[-1] <= limit:
        b.append(_band_after(b[-1], percent))
    return b


def _band_after(start: int, percent: int) -> int:
    return start * 10_000 // (percent * percent) + 1


def block_count(band_end: int, percent: int) -> tuple[int, int]:
    """(most bits by which linked sketches of the band differ, slack blocks)."""
    most = (100 - percent) * 2 * (band_end - 1) // (100 + percent)
    return most, (1 + most // 10 if most else 0)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    h = common.shingle_hashes(words, k)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def _band_keys(h: np.ndarray, band: int, end: int, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the blocks of a sorted set in one band, and the slack that is left: below 0 if some empty blocks have keys."""
    most, slack = block_count(end, percent)
    p = most + 1 + slack
    sums, seen = np.zeros(p, dtype=np.uint64), np.zeros(p, dtype=bool)
    for lo in range(0, len(h), common.SLICE_WORDS):
        part = h[lo : lo + common.SLICE_WORDS]
        block = ((part >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        bits = common.mix((part & np.uint64(0xFFFFFFFFFF)) * np.uint64(0xA24BAED4963EE407) + np.uint64(1))
        sums[block[first]] ^= np.bitwise_xor.reduceat(bits, first)
        seen[block[first]] = True
    label = np.uint64(band) << np.uint64(40)
    full = np.flatnonzero(seen)
    keys = common.mix(sums[full] ^ common.mix(label + full.astype(np.uint64)))
    empty = p - len(full)
    if empty > slack:
        free = np.flatnonzero(~seen)[slack:].astype(np.uint64)
        keys = np.concatenate((keys, common.mix(common.mix(label + free) + np.uint64(7))))
        return keys, -1
    return keys, slack - empty


def _signature(h: np.ndarray) -> tuple[int, int]:
    """128 bits that tell a set of shingle hashes from others."""
    one, two = np.uint64(0), 0
    for lo in range(0, len(h), common.SLICE_WORDS):
        part = h[lo : lo + common.SLICE_WORDS]
        one ^= np.bitwise_xor.reduce(common.mix(part + np.uint64(11)))
        two += int(np.add.reduce(common.mix(part + np.uint64(23)), dtype=np.uint64))
    return int(one.view(np.int64)), int(np.uint64(two & (1 << 64) - 1).view(np.int64))


def _bits(h: np.ndarray) -> bytes:
    """The dense parity sketch of a set: a power of two bits, at least two a shingle and 64 in all. A long one is made by parts."""
    width = max(64, 1 << (2 * max(1, len(h)) - 1).bit_length())
    size = min(width, common.SLICE_WORDS)
    places = h & np.uint64(width - 1)
    if width > size:
        places.sort()
    cuts = np.searchsorted(places, np.arange(size, width, size, dtype=np.uint64))
    odd = (np.bincount((part & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1 for part in np.split(places, cuts))
    return b"".join(np.packbits(x.astype(np.uint8)).tobytes() for x in odd)


_SKETCHED = "doc_id long, th long, t2 int, n long, c long, s2 long, spare int, bits binary, keys array<long>"


def _sketch(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    bands = size_bands(1 << 20, percent)
    for batch in batches:
        texts = batch.column(3)
        for lo, hi in common.text_slices(texts):
            raw, offsets = common.string_bytes(texts.slice(lo, hi - lo))
            words, at = common.hashed_words(raw, offsets)
            rows: list[tuple] = []
            for i in range(hi - lo):
                h = shingle_set(words[at[i] : at[i + 1]], k)
                n = len(h)
                if not n:
                    rows.append((0, 0, 0, 0, None, None))
                    continue
                while bands[-1] <= n or bands[-2] <= n:
                    bands.append(_band_after(bands[-1], percent))
                band = int(np.searchsorted(bands, n, side="right")) - 1
                keys, spare = _band_keys(h, band, bands[band + 1], percent)
                if n * 100 >= bands[band + 1] * percent:
                    more, left = _band_keys(h, band + 1, bands[band + 2], percent)
                    keys, spare = np.concatenate((keys, more)), min(spare, left)
                rows.append((n, *_signature(h), spare, _bits(h), keys))
            n, c, s2, spare, bits, keys = zip(*rows, strict=True)
            made = [pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.array(s2, pa.int64()), pa.array(spare, pa.int32()), pa.array(bits, pa.binary()), _lists(list(keys))]
            yield pa.RecordBatch.from_arrays([batch.column(j).slice(lo, hi - lo) for j in range(3)] + made, names=["doc_id", "th", "t2", "n", "c", "s2", "spare", "bits", "keys"])


def _lists(values: list) -> pa.Array:
    sizes = np.fromiter((0 if v is None else len(v) for v in values), dtype=np.int32, count=len(values))
    flat = [v for v in values if v is not None]
    data = np.concatenate(flat).view(np.int64) if flat else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(data))


def _verify(batches: Iterator[pa.RecordBatch], k: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, ta, tb), those of an a next to each other: keeps the pairs that link."""
    held: tuple = (None, None)

    def as_set(text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        return shingle_set(common.hashed_words(raw, np.array([0, len(raw)]))[0], k)

    for batch in batches:
        a, b, ta, tb = (batch.column(i) for i in range(4))
        out = []
        for i in range(batch.num_rows):
            if held[0] != (x := a[i].as_py()):
                held = (x, as_set(ta[i].as_py()))
            x, y = held[1], as_set(tb[i].as_py())
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= percent * (len(x) + len(y) - both):
                out.append(i)
        yield pa.RecordBatch.from_arrays([a.take(pa.array(out, pa.int64())), b.take(pa.array(out, pa.int64()))], names=["a", "b"])


def _both(pairs: DataFrame, rows: DataFrame, what: str) -> DataFrame:
    """``a, b`` with the ``what`` of each of the two as ``xa, xb``. Where an id has many pairs, its row is copied to several tasks."""
    got = pairs
    for side, other in (("b", "a"), ("a", "b")):
        counts = common.written(pairs.groupBy(side).agg(F.count("*").alias("w")), "counts")
        got = common.salted(got, rows.select(F.col("cid").alias(side), F.col(what).alias(f"x{side}")), [side], "w", [other], counts=counts)
    return got.select("a", "b", "xa", "xb")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cid, text`` of the rows ``wanted(cid, th, t2)``; of repeated ones, once."""
    found = common.may_be_in(docs.select("th", "t2", "text"), "th", common.bitmap(wanted, "th")).join(wanted.hint("merge"), ["th", "t2"])
    return found.groupBy("th", "t2").agg(F.first(F.struct("cid", "text")).alias("one")).select("one.*")


def _links(pairs: DataFrame, docs: DataFrame, reps: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` that link, by their whole texts; ``reps(cid, th, t2)`` has their row keys."""
    ids = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    texts = common.written(_texts(docs, common.written(ids.join(reps.hint("merge"), "cid"), "wanted")), "texts")
    links = common.written(_both(pairs, texts, "text").mapInArrow(common.lean(lambda it: _verify(it, k, percent)), "a long, b long"), "verified")
    common.discard(texts)
    return links


def _star(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, and the size and sketch of each): keeps the pairs that are near enough."""
    for batch in batches:
        a, b = batch.column(0), batch.column(1)
        both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
        out = [i for i, (x, y) in enumerate(both) if len(list(_key_pairs([(0, 0, 0, x["n"], x["bits"]), (0, 1, 1, y["n"], y["bits"])], percent, True)))]
        yield pa.RecordBatch.from_arrays([a.take(pa.array(out, pa.int64())), b.take(pa.array(out, pa.int64()))], names=["a", "b"])


def _fold(sketch: bytes, size: int) -> np.ndarray:
    """A sketch of ``size`` bytes from a longer one: halves are XORed, so parities add."""
    x = np.frombuffer(sketch, dtype=np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _key_pairs(rows: list[tuple], percent: int, forest: bool) -> Iterator[tuple[int, int]]:
    """Pairs of one key's classes (own, id, component, n, sketch) in different components whose sketches are near enough.

    With ``forest``, pairs that others connect are left out.  Rows of two parts
    are compared across, those of one part with each other; two sketches as the shorter is.
    """
    rows = sorted(rows, key=lambda r: len(r[4]))
    own, c, comp, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
    size, start, sk = 0, 0, np.zeros((0, 0), np.uint64)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            root[x] = root.get(root[x], root[x])
            x = root[x]
        return x

    two = own.min() != own.max()
    for i in range(len(rows) - 1):
        if len(rows[i][4]) > size:
            size, start = len(rows[i][4]), i
            sk = np.stack([_fold(r[4], size) for r in rows[i:]]).view(np.uint64)
        js = np.flatnonzero(comp[i + 1 :] != comp[i]) + i + 1
        if two:
            js = js[own[js] != own[i]]
        if not len(js):
            continue
        lo, hi = np.minimum(n[js], n[i]), np.maximum(n[js], n[i])
        most = (100 - percent) * (lo + hi) // (100 + percent)
        js, most = js[lo * 100 >= percent * hi], most[lo * 100 >= percent * hi]
        if not len(js):
            continue
        near = np.bitwise_count(sk[js - start] ^ sk[i - start]).sum(axis=1, dtype=np.int64) <= most
        for j in js[near].tolist():
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x != y or not forest:
                root[x] = y
                yield int(min(c[i], c[j])), int(max(c[i], c[j]))


def _near(batches: Iterator[pa.RecordBatch], percent: int, forest: bool) -> Iterator[pa.RecordBatch]:
    """Rows (key, t, p, q, m, own, cid, component, n, bits), those of a block next to each other; gives (key, m, a, b)."""

    def blocks() -> Iterator[tuple[int, int, int, int]]:
        held: list[tuple] = []
        at: tuple = ()
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(10)]
            for row in zip(*cols, strict=True):
                if row[:5] != at:
                    if len(held) > 1:
                        yield from ((at[0], at[4], a, b) for a, b in _key_pairs(held, percent, forest))
                    held, at = [], row[:5]
                held.append(row[5:])
        if len(held) > 1:
            yield from ((at[0], at[4], a, b) for a, b in _key_pairs(held, percent, forest))

    pairs = blocks()
    while part := list(islice(pairs, OUTPUT)):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*part, strict=True)], names=["key", "m", "a", "b"])


def _near_pairs(named: DataFrame, bits: DataFrame, percent: int, forest: bool) -> DataFrame:
    """``key, m, a, b``: pairs of near sketches in different components, among ``key, cid, component, n, m`` (m rows of the key, at most).

    A key's rows meet in one block, or if they are many, in blocks of parts.  Its
    largest component is compared with the others and not with itself, so a
    key of many copies and a few others costs no more than their number.
    """
    each = named.groupBy("key", "component").agg(F.count("*").alias("size"), F.sum("n").alias("words"), F.max("m").alias("m"))
    per = each.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.max(F.struct("size", "words")).alias("top"), F.sum("size").alias("size"), F.sum("words").alias("words"), F.max("m").alias("m"), F.count("*").alias("spans")).filter("spans > 1")
    count = lambda size, words: F.greatest(F.ceil(size / BUCKET), F.ceil(words / BUCKET_WORDS), F.lit(1)).cast("int")
    per = per.select("key", "main", "m", F.col("m").alias("rows"), count(F.col("size"), F.col("words")).alias("all"), count(F.col("top.size"), F.col("top.words")).alias("lp"), count(F.col("size") - F.col("top.size"), F.col("words") - F.col("top.words")).alias("rp"))
    per = common.written(per, "spans")
    rows = common.salted(named, per, ["key"], "m", ["cid"], known=True)
    is_main = F.col("component") == F.col("main")
    mine = F.pmod(F.xxhash64("cid"), F.when(is_main, F.col("lp")).otherwise(F.col("rp"))).cast("int")
    rows = rows.withColumn("mine", F.when(F.col("all") == 1, 0).otherwise(mine)).withColumn("own", F.when(F.col("all") == 1, 0).when(is_main, -1).otherwise(F.col("mine")))
    block = lambda t, p, q: F.struct(F.lit(t).alias("t"), p.alias("p"), q.alias("q"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    mine = F.col("mine")
    many = F.when(is_main, F.transform(upto("rp"), lambda j: block(1, mine, j))).otherwise(F.concat(F.transform(upto("lp"), lambda i: block(1, i, mine)), F.transform(upto("rp"), lambda j: block(2, F.least(mine, j), F.greatest(mine, j)))))
    dealt = rows.withColumn("block", F.explode(F.when(F.col("all") == 1, F.array(block(0, F.lit(0), F.lit(0)))).otherwise(many)))
    dealt = dealt.select("key", "block.*", "rows", "own", "cid", "component").join(bits.hint("merge"), "cid")
    dealt = dealt.repartition("key", "t", "p", "q").sortWithinPartitions("key", "t", "p", "q", "own", "cid").select("key", "t", "p", "q", "rows", "own", "cid", "component", "n", "bits")
    return common.written(dealt.mapInArrow(common.lean(lambda it: _near(it, percent, forest)), "key long, m long, a long, b long"), "near")


def _set_hashes(column: str) -> list[Column]:
    """128 bits of a group's distinct values, in whatever order they come."""
    return [F.bit_xor(F.xxhash64(F.lit(i), column)).alias(f"set{i}") for i in (1, 2)]


def _one_of_equal_keys(heads: DataFrame) -> DataFrame:
    """``key, m, lo, times``: of the keys whose classes are all the same, the least, and how many it stands for."""
    return heads.groupBy("m", "lo", "hi", "set1", "set2").agg(F.min("key").alias("key"), F.sum("times").alias("times")).select("key", "m", "lo", "times")


def _without_slack(often: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows ``key, cid, m, times, ...`` of common keys, without those that the slack of a class makes up for: the most common ones, as far as it goes."""
    before = Window.partitionBy("cid").orderBy(F.desc("m"), "key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slack = often.join(classes.select("cid", "spare").hint("merge"), "cid").withColumn("used", F.sum("times").over(before))
    return slack.filter("used > spare").drop("spare", "used")


def _merged(often: DataFrame) -> DataFrame:
    """``key, cid, n, m`` of ``key, cid, n, m, lo``: keys of the same ``lo`` become one, with the classes of all, where that makes no more pairs to compare.

    Copies with edits meet in nearly all of their blocks, in each of them without
    the few that were edited there.  Each pair that met in one of the keys meets in
    the merged one, and once.
    """
    each = often.groupBy("lo", "key").agg(F.count("*").alias("size"))
    keys = each.groupBy("lo").agg(F.min("key").alias("one"), F.count("*").alias("keys"), F.sum("size").alias("w"), F.sum(F.col("size") * F.col("size")).alias("pairs")).filter("keys > 1")
    union = often.select("lo", "cid").distinct().groupBy("lo").agg(F.count("*").alias("all"))
    groups = common.written(keys.join(union.hint("merge"), "lo").filter("`all` * `all` <= pairs").select("lo", "one", "all", "w"), "groups")
    rows = common.salted(often, groups, ["lo"], "w", ["cid"], "left")
    return rows.select(F.coalesce("one", "key").alias("key"), "cid", "n", F.coalesce("all", "m").alias("m")).distinct()


def _joined(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, th, t2, n, component_id, first``: the row key of each document and of the first of its component."""
    spark = docs.sparkSession
    common.short_batches(spark)
    th, t2 = common.row_key()
    docs = docs.withColumns({"th": th, "t2": t2})
    path = common.scratch_path(spark, "sketches")
    docs.select("doc_id", "th", "t2", "text").mapInArrow(common.lean(lambda it: _sketch(it, k, percent)), _SKETCHED).write.parquet(path)
    t0 = spark.read.parquet(path)
    slim = common.written(t0.drop("keys", "bits"), "slim")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "t2"))
    classes = slim.filter("n > 0").groupBy("c", "s2", "n").agg(first.alias("rep"), F.count("*").alias("size"), F.min("spare").alias("spare"))
    classes = common.written(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")

    rows = t0.select("c", F.explode("keys").alias("key"))
    # A slice of the keys at a time, so that the disks hold the shuffle of one.
    slices = []
    for i in range(SLICES):
        part = rows.filter(F.pmod(F.shiftrightunsigned("key", 7), F.lit(SLICES)) == i)
        part = part.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("m")).filter("lo < hi")
        slices.append(common.written(part, "met"))
    met = reduce(DataFrame.union, slices)
    several = common.may_be_in(rows, "key", common.bitmap(met.filter("m > 2").select("key"), "key")).select("key", "c")
    two = met.filter("m = 2").groupBy("lo", "hi").agg(F.min("key").alias("key"), F.count("*").alias("times")).select("key", F.explode(F.array("lo", "hi")).alias("c"), "times")
    # Classes of one 64-bit hash, should there be any, meet in a key of their own.
    same = classes.groupBy("c").agg(F.count("*").alias("m")).filter("m > 1").select(F.col("c").alias("key"), "c")
    once = several.union(same).withColumn("times", F.lit(1).cast("long"))
    found = once.union(two).groupBy("key", "c").agg(F.max("times").alias("times")).join(classes.select("c", "cid", "n").hint("merge"), "c").select("key", "cid", "n", "times")
    found = common.written(found, "found")
    # What the bitmap let through by chance has keys of one class.
    heads = found.groupBy("key").agg(F.count("*").alias("m"), F.min("cid").alias("lo"), F.max("cid").alias("hi"), *_set_hashes("cid"), F.max("times").alias("times")).filter("m > 1")
    heads = common.written(_one_of_equal_keys(heads), "heads")
    members = common.written(common.salted(found.drop("times"), heads.withColumn("w", F.col("m")), ["key"], "w", ["cid"]), "members")
    common.discard(*slices, found, heads)

    needed = members.select("cid").distinct().join(classes.hint("merge"), "cid").select("cid", F.col("rep.th").alias("th"), F.col("rep.t2").alias("t2"))
    needed = common.written(needed, "needed")
    bits = common.may_be_in(t0.select("th", "t2", "n", "bits"), "th", common.bitmap(needed, "th")).join(needed.hint("merge"), ["th", "t2"])
    bits = common.written(bits.groupBy("th", "t2").agg(F.first(F.struct("cid", "n", "bits")).alias("one")).select("one.*"), "bits")
    common.remove(spark, path)

    # Each class is first compared with the least class of most of its keys.
    star = members.filter("cid != lo").groupBy(F.col("lo").alias("a"), F.col("cid").alias("b")).agg(F.sum("times").alias("w"))
    best = common.written(star.groupBy("b").agg(F.max_by("a", F.struct("w", "a")).alias("a")).select("a", "b"), "best")
    near = _both(best, bits.withColumn("sketch", F.struct("n", "bits")), "sketch").mapInArrow(common.lean(lambda it: _star(it, percent)), "a long, b long")
    links = _links(common.written(near, "star"), docs, needed, k, percent)
    common.discard(best)
    labels = components(links)

    often = common.written(_without_slack(members.filter(F.col("m") > COMMON_KEY), classes), "often")
    open_ = members.filter(F.col("m") <= COMMON_KEY).select("key", "cid", "n", "m").union(_merged(often))
    open_ = common.written(open_, "open")

    for forest in (True, False):
        # First a spanning forest of the near sketches of each key; then, of the
        # components that are left, every near pair: few, for their texts just miss.
        named = open_.join(labels.select(F.col("id").alias("cid"), "component").hint("merge"), "cid", "left").select("key", "cid", "n", "m", F.coalesce("component", "cid").alias("component"))
        near = _near_pairs(named, bits, percent, forest)
        pairs = common.written(near.select("a", "b").distinct(), "pairs")
        more = pairs if pairs.isEmpty() else _links(pairs, docs, needed, k, percent)
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)
        # Keys without a near pair have none between what is left either.
        left = common.written(near.groupBy("key").agg(F.max("m").alias("m"), F.max("m").alias("rows")), "left")
        if not forest or left.isEmpty():
            break
        open_ = common.written(common.salted(open_, left, ["key"], "m", ["cid"], known=True).withColumnRenamed("rows", "m").select("key", "cid", "n", "m"), "open")

    # Components by class, then classes to documents; both large kinds are dealt to many tasks.
    linked = classes.join(labels.select(F.col("id").alias("cid"), "component"), "cid").select("cid", "component", "rep")
    tops = common.written(linked.groupBy("component").agg(F.min("rep").alias("first"), F.count("*").alias("w")), "tops")
    firsts = common.salted(linked, tops, ["component"], "w", ["cid"]).select("cid", "first")
    answer = classes.join(firsts, "cid", "left").select("c", "s2", "n", "size", F.coalesce("first", "rep").alias("first"))
    answer = common.written(answer, "answer")
    own = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "t2")
    full = common.salted(slim.filter("n > 0").drop("spare"), answer, ["c", "s2", "n"], "size", [F.monotonically_increasing_id()]).select("doc_id", "th", "t2", "n", "first")
    return full.union(slim.filter("n = 0").select("doc_id", "th", "t2", "n", own))


def ngram_join(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their
    distinct k-word shingles (A-Z lowered; fewer than k words count as one
    shingle).  ``component_id`` is the least doc_id reachable by links.

    Null or empty texts have no shingles and stay alone.  Repeated rows give
    repeated results, and rows of one id with different texts link each for
    itself.  Rows without an id link like others; the component of such rows
    alone has a null id.  An empty table gives an empty one.  Other columns are
    ignored, so their names can't clash.
    """
    found = _joined(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), k, percent)
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Of each group of near duplicates one document, with all its columns: that of least doc_id, and of least hash of its text among equal ids.

    Documents go by id and text together, so rows that share an id but not the
    text are told apart, and of rows repeated whole one stays.  Rows without an
    id are the last choice.  Null and empty texts are no duplicates of each
    other: all stay, repeated or not.  An empty table stays so.
    Helper columns take names that the table doesn't have.

    A bitmap of the rows in question sorts out most others without a shuffle.
    """
    found = _joined(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k, percent).filter("n > 0")
    stays = (F.col("first.th") == F.col("th")) & (F.col("first.t2") == F.col("t2"))
    seen = found.groupBy("th", "t2").agg(F.max(stays).alias("stays"), F.count("*").alias("w")).filter("not stays or w > 1")
    h, h2, stay, w = (common.free_name(docs, n) for n in ("row_hash", "row_hash2", "row_stays", "row_times"))
    touched = common.written(seen.select(F.col("th").alias(h), F.col("t2").alias(h2), F.col("stays").alias(stay), F.col("w").alias(w)), "touched")
    bits = common.bitmap(touched, h)
    th, t2 = common.row_key()
    hashed, columns = docs.withColumns({h: th, h2: t2}), common.columns_of(docs)
    near = common.salted(common.may_be_in(hashed, h, bits), touched, [h, h2], w, [F.monotonically_increasing_id()], "left")
    once = near.filter(F.col(stay)).dropDuplicates([h, h2])
    rest = near.filter(F.col(stay).isNull())
    return common.not_in(hashed, h, bits).select(columns).union(rest.select(columns)).union(once.select(columns))
