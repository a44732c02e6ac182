"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A seed is three words of a test item, in a row or with one left out between, that
ordinary text would rarely have: the product of its words' shares of all corpus
words is small.  Documents are read for the same three forms, any of which may
meet any, so seeds survive words that were replaced, left out or put in, up to
every third.  Rareness
is judged by the words, not by the run's own count, so an item that was copied
into thousands of documents keeps its seeds.  However common its words, an item
has a seed in each WINDOW words, so no part of that length goes unseen; items of
fewer words than a seed are looked for whole.  Documents are scanned once; where
a seed is met, the words around it are aligned with the item (local alignment,
match 2, mismatch and gap -1), so paraphrased and edited copies score too.

The documents are read twice, however large the benchmark: once to count the
words of its items, once to look for its seeds.  Seeds and items whose size is
below LOCAL_BYTES go to every task.  Larger ones stay tables: documents are
probed by a bitmap of the seeds, hits are joined with the seeds, and the texts of
the documents that were hit, which are read once more, with the items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import row_key

SEED, MATCH = 3, 2
#: The places of a seed's words: in a row, or with one word between that doesn't matter.
FORMS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))
#: An item is met if its best alignment reaches this share of a full match, or the score of so many words in a row.
LEAST, WORDS = 0.4, 13
#: Short items need more than that share: as many aligned words as they have, but no more than this.
ALIGNED = 8
#: A seed is rare that ordinary text has at most so often a word; each is kept.
RARE = 3e-9
#: The rarest seed of each so many words in a row of an item is kept, rare or not.
WINDOW = 8
#: Each item keeps so many of its rarest seeds in any case.
KEPT = 6
#: Bytes of seeds and words of items that go to every task; beyond, they are joined as tables.
LOCAL_BYTES = 32 << 20
#: Seeds of a text that are looked up at once.
LOOKED_UP = 1 << 16

_APART = np.zeros(256, dtype=bool)
_APART[[*range(0x21), *range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, lowered and cut at ASCII punctuation and white space; for n texts n+1 positions."""
    raw, offsets = common.string_bytes(pa.compute.utf8_lower(texts.cast(pa.large_string())))
    return common.hashed_words(raw, offsets, _APART, lower=False)


def runs(words: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Hashes of all runs of k words, and of SEED words in each of the forms, by their first words: (span, hashes). Forms with the same words have the same hash."""
    if k < SEED:
        if len(words) >= k:
            yield k, common.shingle_hashes(words, k)
        return
    for form in FORMS:
        if len(words) > form[-1]:
            yield form[-1] + 1, common.run_hashes(words, form, 0x9FB21C651E98DF25)


@dataclass
class Items:
    """Items that every task has: ids and words of each, and by run length (1, 2: whole short items, SEED) the seeds, sorted by hash, with their (item, place)."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def hits(self, words: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of a text where a seed of k words begins, and its hash."""
        seeds, found = self.seeds[k][0], [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
        for _, s in runs(words, k) if len(seeds) else ():
            for lo in range(0, len(s), common.SLICE_WORDS):
                part = s[lo : lo + common.SLICE_WORDS]
                at = np.minimum(np.searchsorted(seeds, part), len(seeds) - 1)
                hit = np.flatnonzero(seeds[at] == part)
                found.append((hit + lo, part[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def filter_bits(self) -> np.ndarray:
        return _bits_of(np.concatenate([self.seeds[k][0] for k in self.seeds]))


def _shift(n: int) -> int:
    """How far the hashes of a set of n are shifted to be places of a bitmap: 16 bits a hash, 16 MB at most."""
    return 64 - min(27, max(16, (16 * n).bit_length()))


def _bits_of(hashes: np.ndarray) -> np.ndarray:
    """A bitmap of hashes as words of 64 bits."""
    shift = _shift(len(hashes))
    bits = np.zeros(1 << (64 - shift), dtype=np.uint8)
    bits[(hashes >> np.uint64(shift)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in a bitmap, and a few others."""
    shift = np.uint64(64 - (len(bits) * 64 - 1).bit_length())
    found = np.empty(len(hashes), dtype=bool)
    for lo in range(0, len(hashes), common.SLICE_WORDS):
        place = hashes[lo : lo + common.SLICE_WORDS] >> shift
        found[lo : lo + len(place)] = (bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return found


def kept_seeds(rate: np.ndarray, span: int = SEED) -> np.ndarray:
    """Places of an item's seeds of one form, given how often ordinary text has each: KEPT ones, rare ones, and the rarest of each WINDOW words."""
    order = np.argsort(rate, kind="stable")
    keep = rate <= RARE
    keep[order[:KEPT]] = True
    size = WINDOW - span + 1
    if len(rate) > size:
        keep[np.lib.stride_tricks.sliding_window_view(rate, size).argmin(axis=1) + np.arange(len(rate) - size + 1)] = True
    return np.flatnonzero(keep)


def seeds_of(words: np.ndarray, share: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """The seeds of an item, given each word's share of all words of the corpus: their length in words, their hashes and places."""
    k = min(SEED, len(words))
    if k < SEED:
        return k, common.shingle_hashes(words, max(1, k)), np.zeros(min(1, k), np.int64)
    seeds, places = [], []
    for form, (span, h) in zip(FORMS, runs(words, SEED)):
        keep = kept_seeds(np.prod([share[j : j + len(h)] for j in form], axis=0), span)
        seeds.append(h[keep])
        places.append(keep)
    return k, np.concatenate(seeds), np.concatenate(places)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of an item in a text: (score, first word, end word)."""

    def run(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
        steps = np.arange(len(b))
        row = np.zeros(len(b) + 1, dtype=np.int64)
        best = (0, 0, 0)
        for i, x in enumerate(a):
            now = np.maximum(row[:-1] + np.where(b == x, MATCH, -1), row[1:] - 1)
            np.maximum(now, 0, out=now)
            row[1:] = np.maximum.accumulate(now + steps) - steps
            j = int(row[1:].argmax())
            if row[j + 1] > best[0]:
                best = (int(row[j + 1]), i + 1, j + 1)
        return best

    score, i, j = run(item, text)
    if not score:
        return 0, 0, 0
    _, _, back = run(item[:i][::-1], text[:j][::-1])
    return score, j - back, j


def bar(n: int, least: float) -> float:
    """The share of a full match from which an item of n words is met."""
    return min(max(least, min(n, ALIGNED) / n), WORDS / n) if n else 1.0


def aligned(words: np.ndarray, mine: np.ndarray, diagonals: np.ndarray, least: float) -> tuple[float, int, int] | None:
    """Where an item is met in a text, near the diagonals (place in the text less place in the item) of its seeds: share of a full match, first word, end word."""
    slack = len(mine) // 3 + 8
    d = np.unique(diagonals)
    cuts = np.flatnonzero(np.diff(d) > 2 * slack + len(mine)) + 1
    best = (0.0, 0, 0)
    for part in np.split(d, cuts):
        a, b = max(0, int(part[0]) - slack), min(len(words), int(part[-1]) + len(mine) + slack)
        # An alignment has no more matches than the item has words that are there at all.
        if np.isin(mine, words[a:b]).sum() < bar(len(mine), least) * len(mine):
            continue
        score, x, y = align(mine, words[a:b])
        best = max(best, (score / (MATCH * len(mine)), a + x, a + y), key=lambda t: t[0])
    return best if best[0] >= bar(len(mine), least) else None


def matches(words: np.ndarray, items: Items, least: float) -> list[tuple[int, float, int, int]]:
    """Items met in a text: (number of the item, share of a full match, first word, end word), best place of each."""
    found = []
    for k, (seeds, item, place) in items.seeds.items():
        hit, s = items.hits(words, k)
        if not len(hit):
            continue
        near = [np.zeros((2, 0), np.int64)]
        for cut in range(0, len(hit), LOOKED_UP):
            at, h = hit[cut : cut + LOOKED_UP], s[cut : cut + LOOKED_UP]
            lo, hi = np.searchsorted(seeds, h, side="left"), np.searchsorted(seeds, h, side="right")
            # The n-th entry of each seed in turn: a repetitive text meets no more pairs at once than it has places.
            for n in range(int((hi - lo).max())):
                more = lo + n < hi
                entry = lo[more] + n
                near.append(np.unique(np.stack((item[entry], at[more] - place[entry])), axis=1))
            if len(near) > 64:
                near = [np.unique(np.concatenate(near, axis=1), axis=1)]
        pairs = np.unique(np.concatenate(near, axis=1), axis=1)
        ids, first = np.unique(pairs[0], return_index=True)
        for i, diagonals in zip(ids.tolist(), np.split(pairs[1], first[1:]), strict=True):
            if k < SEED:
                found.append((i, 1.0, int(diagonals.min()), int(diagonals.min()) + k))
            elif met := aligned(words, items.words[i], diagonals, least):
                found.append((i, *met))
    return found


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in common.text_slices(batch.column(2)):
            h, at = words_of(batch.column(2).slice(lo, hi - lo))
            words = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(h.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), words], names=["item", "item_id", "words"])


def _count_words(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Counts of the wanted words (sorted hashes; all words if None) in each slice of texts, and at -1 of all its words."""
    bits = None if wanted is None else _bits_of(wanted)
    for batch in batches:
        for lo, hi in common.text_slices(batch.column(0)):
            h, _ = words_of(batch.column(0).slice(lo, hi - lo))
            total = len(h)
            if wanted is not None:
                h = h[_marked(bits, h)]
                at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
                h = h[wanted[at] == h]
            word, n = np.unique(h, return_counts=True)
            kind = np.concatenate((np.zeros(len(word), np.int32), [1]))
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(np.append(word.view(np.int64), 0), pa.int64()), pa.array(np.append(n, total), pa.int64())], names=["all", "word", "n"])


def _choose(batches: Iterator[pa.RecordBatch], total: int) -> Iterator[pa.RecordBatch]:
    """Rows (item, words with their counts in order): the item's seeds."""
    for batch in batches:
        out: list[tuple[int, int, int, int]] = []
        for item, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = np.array([c["word"] for c in cells], np.int64).view(np.uint64)
            k, seeds, places = seeds_of(words, np.array([c["n"] for c in cells]) / total)
            out += [(k, int(s), item, int(p)) for s, p in zip(seeds.view(np.int64), places, strict=True)]
        k, seed, item, place = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(seed, pa.int64()), pa.array(item, pa.int64()), pa.array(place, pa.int64())], names=["k", "seed", "item", "place"])


def _seeds(texts: DataFrame, items: DataFrame) -> DataFrame:
    """``k, seed, item, place`` of all items ``item, item_id, words``, by how often the corpus has their words."""
    words = items.select("item", F.posexplode("words").alias("pos", "word"))
    vocabulary = common.written(words.groupBy("word").agg(F.count("*").alias("w")), "vocabulary")
    wanted = None
    if common.small_enough(vocabulary, 8):
        wanted = np.unique(np.array([r["word"] for r in vocabulary.select("word").collect()], np.int64).view(np.uint64))
        if not len(wanted):
            return texts.sparkSession.createDataFrame([], "k int, seed long, item long, place long")
    counted = texts.select("text").mapInArrow(common.lean(lambda it: _count_words(it, wanted)), "all int, word long, n long")
    counted = common.written(counted.groupBy("all", "word").agg(F.sum("n").alias("n")), "counts")
    total = max(1, counted.filter("all = 1").agg(F.sum("n")).first()[0] or 1)
    rates = common.written(vocabulary.join(counted.filter("all = 0").select("word", "n"), "word", "left").select("word", "w", F.coalesce("n", F.lit(0)).alias("n")), "rates")
    cells = common.salted(words, rates, ["word"], "w", ["item", "pos"]).groupBy("item").agg(F.sort_array(F.collect_list(F.struct("pos", "word", "n"))).alias("cells"))
    return cells.mapInArrow(common.lean(lambda it: _choose(it, total)), "k int, seed long, item long, place long")


def _find(batches: Iterator[pa.RecordBatch], items: Items, least: float) -> Iterator[pa.RecordBatch]:
    bits = items.filter_bits()
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in common.text_slices(texts):
            h, at = words_of(texts.slice(lo, hi - lo))
            docs = _near_docs(h, at, bits, [k for k in items.seeds if len(items.seeds[k][0])])
            rows = [(i, *m) for i in docs.tolist() for m in matches(h[at[i] : at[i + 1]], items, least)]
            if rows:
                doc, item, score, a, b = zip(*rows, strict=True)
                key = ids.slice(lo, hi - lo).cast(pa.int64()).take(pa.array(doc, pa.int64()))
                yield pa.RecordBatch.from_arrays([key, pa.array([items.ids[i] for i in item], pa.int64()), pa.array(score, pa.float64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["doc_id", "item_id", "score", "first_word", "end_word"])


def _near_docs(h: np.ndarray, at: np.ndarray, bits: np.ndarray, lengths: list[int]) -> np.ndarray:
    """Numbers of the texts in which a run of some length may be a seed."""
    near = [np.flatnonzero(_marked(bits, s)) for k in lengths for _, s in runs(h, k)]
    return np.unique(np.searchsorted(at, np.concatenate(near), side="right") - 1) if near else np.zeros(0, np.int64)


def _probe(batches: Iterator[pa.RecordBatch], bits: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (key, key2, text): the runs that may be seeds, with their places."""
    for batch in batches:
        for lo, hi in common.text_slices(batch.column(2)):
            h, at = words_of(batch.column(2).slice(lo, hi - lo))
            for k, span, s in ((k, span, s) for k in range(1, SEED + 1) for span, s in runs(h, k)):
                hit = np.flatnonzero(_marked(bits, s))
                doc = np.searchsorted(at, hit, side="right") - 1
                inside = hit + span <= at[doc + 1]
                hit, doc = hit[inside], doc[inside]
                if len(hit):
                    rows = pa.array(doc, pa.int64())
                    yield pa.RecordBatch.from_arrays([*(batch.column(j).slice(lo, hi - lo).take(rows) for j in range(2)), pa.array(np.full(len(hit), k), pa.int32()), pa.array(s[hit].view(np.int64)), pa.array(hit - at[doc], pa.int64())], names=["th", "t2", "k", "seed", "at"])


def _align(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, item_id, k, text, words, diagonals), those of a text next to each other."""
    for batch in batches:
        held: tuple[str | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        rows = []
        ids, items, ks, texts, words, near = (batch.column(j) for j in range(6))
        for i in range(batch.num_rows):
            if (text := texts[i].as_py()) != held[0]:
                held = (text, words_of(pa.array([text], pa.string()))[0])
            mine, d = np.asarray(words[i].values.to_numpy(zero_copy_only=False)).view(np.uint64), near[i].values.to_numpy(zero_copy_only=False)
            k = ks[i].as_py()
            met = (1.0, int(d.min()), int(d.min()) + k) if k < SEED else aligned(held[1], mine, d, least)
            if met:
                rows.append((ids[i].as_py(), items[i].as_py(), *met))
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "item_id", "score", "first_word", "end_word"), r, strict=True)) for r in rows], schema=pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))


_ROW = "doc_id long, item_id long, score double, first_word long, end_word long"


def _by_tables(texts: DataFrame, items: DataFrame, seeds: DataFrame, least: float) -> DataFrame:
    """As ``_find``, with seeds and items as tables."""
    spark = texts.sparkSession
    shift = _shift(seeds.count())
    place = F.shiftrightunsigned("seed", shift)
    packed = seeds.groupBy(F.shiftright(place, 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))).alias("b")).toPandas()
    words = np.zeros(1 << (58 - shift), dtype=np.uint64)
    words[packed["w"].to_numpy(np.int64)] = packed["b"].to_numpy(np.int64).view(np.uint64)
    bits = spark.sparkContext.broadcast(words)
    th, t2 = row_key()
    keyed = texts.withColumns({"th": th, "t2": t2})
    hits = keyed.select("th", "t2", "text").mapInArrow(common.lean(lambda it: _probe(it, bits.value)), "th long, t2 int, k int, seed long, at long")
    hits = common.written(hits.join(F.broadcast(seeds.select("k").distinct()), "k"), "hits")
    times = hits.groupBy("k", "seed").agg(F.count("*").alias("w"))
    per = common.written(seeds.groupBy("k", "seed").agg(F.collect_list(F.struct("item", "place")).alias("places")).join(times, ["k", "seed"]), "places")
    met = common.salted(hits, per, ["k", "seed"], "w", ["th", "at"]).select("th", "t2", "k", "at", F.explode("places").alias("x"))
    pairs = met.select("th", "t2", "k", F.col("x.item").alias("item"), (F.col("at") - F.col("x.place")).alias("d")).groupBy("th", "t2", "k", "item").agg(F.collect_set("d").alias("near"))
    pairs = common.written(pairs, "pairs")
    by_item = common.written(items.join(pairs.groupBy("item").agg(F.count("*").alias("w")), "item").select("item", "item_id", "words", "w"), "met-items")
    full = common.salted(pairs, by_item, ["item"], "w", ["th"])
    by_text = common.written(pairs.groupBy("th", "t2").agg(F.count("*").alias("w")), "met-texts")
    # Rows that agree in id and text are one text here, and as many rows again at the end.
    found = common.may_be_in(keyed, "th", common.bitmap(by_text, "th")).join(by_text.drop("w"), ["th", "t2"])
    rows = common.written(found.groupBy("th", "t2").agg(F.first(F.struct("doc_id", "text")).alias("one"), F.count("*").alias("times")).join(by_text, ["th", "t2"]), "texts")
    full = common.salted(full, rows, ["th", "t2"], "w", ["item"])
    full = full.select("one.doc_id", "item_id", "k", "one.text", "words", "near", "times").withColumn("one_of", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return full.select("doc_id", "item_id", "k", "text", "words", "near").mapInArrow(common.lean(lambda it: _align(it, least)), _ROW)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id, item_id, score, first_word, end_word``: documents that hold a test item, whole or edited.

    Words are lowered and cut at ASCII punctuation and white space.  ``score``
    is that of the best local alignment over that of a full match.  Items of
    one or two words are met wherever they stand whole; null texts have no
    words.  A part of an item counts from LEAST of it on, but not below ALIGNED
    words (of a shorter item, all), or from WORDS words.
    Items of equal text and documents of equal text are each reported, and a
    document without an id with a null one.  Items without an id or a text are
    left out.  An empty table on either side gives no rows.
    Other columns are ignored.
    """
    spark = docs.sparkSession
    common.short_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.filter("item_id is not null and text is not null").select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text")
    items = common.written(items.mapInArrow(common.lean(_item_words), "item long, item_id long, words array<long>").filter("size(words) > 0"), "items")
    seeds = common.written(_seeds(texts, items), "seeds")
    size = seeds.count() * 24 + (items.agg(F.sum(F.size("words"))).first()[0] or 0) * 8
    if not size:
        return spark.createDataFrame([], _ROW)
    if size > LOCAL_BYTES:
        return _by_tables(texts, items, seeds, least)
    rows = items.select("item", "item_id", "words").orderBy("item").toArrow().combine_chunks()
    lists = rows["words"].combine_chunks() if isinstance(rows["words"], pa.ChunkedArray) else rows["words"]
    words = [np.asarray(lists[i].values).astype(np.int64).view(np.uint64) for i in range(len(lists))]
    taken = seeds.select("k", "seed", "item", "place").toArrow()
    k, seed, item, place = (np.asarray(taken[c]).astype(np.int64) for c in ("k", "seed", "item", "place"))
    # Monotonic ids become numbers of rows.
    item = np.searchsorted(np.asarray(rows["item"]).astype(np.int64), item)
    sorted_seeds = {}
    for n in range(1, SEED + 1):
        by = np.flatnonzero(k == n)
        by = by[np.lexsort((place[by], item[by], seed[by].view(np.uint64)))]
        sorted_seeds[n] = (seed[by].view(np.uint64), item[by], place[by])
    block = spark.sparkContext.broadcast(Items(rows["item_id"].to_pylist(), words, sorted_seeds))
    return texts.mapInArrow(common.lean(lambda it: _find(it, block.value, least)), _ROW)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents that hold no test item, with all their columns.

    Documents go by id and text together: one without an id goes if its text
    holds an item, and of rows that share an id only those whose text does.
    Repeated rows share their fate; null and empty texts stay; an empty table
    on either side changes nothing.  Helper columns take names that the table
    doesn't have.

    A row is numbered by 64 bits of hash.  A bitmap of the numbers found sorts
    out nearly all clean rows without a shuffle.
    """
    h, gone, w = (common.free_name(docs, n) for n in ("row_hash", "row_leaks", "row_times"))
    hashed = docs.withColumn(h, row_key()[0])
    # The row's hash stands in for the id, so the rows found are known by it.
    found = contaminated(hashed.select(F.col(h).alias("doc_id"), "text"), benchmark, least).select("doc_id").distinct()
    found = common.written(found.select(F.col("doc_id").alias(h)), "leaks")
    bits = common.bitmap(found, h)
    near = common.may_be_in(hashed, h, bits)
    per = common.written(near.groupBy(h).agg(F.count("*").alias(w)).join(found, h).withColumn(gone, F.lit(True)), "gone")
    kept = common.salted(near, per, [h], w, [F.monotonically_increasing_id()], "left").filter(F.col(gone).isNull())
    columns = common.columns_of(docs)
    return common.not_in(hashed, h, bits).select(columns).union(kept.select(columns))


def plain_words(text: str) -> list[str]:
    """The words of a text as this module cuts them; for tests."""
    return [w for w in re.split(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower()) if w]
