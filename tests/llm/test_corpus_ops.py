"""Near duplicates, decontamination, token files, toxicity, the pipeline."""

import io
import json
import random
import time
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, mixing, ngram_join, token_store, toxicity
from tidemark.llm import components as components_module
from tidemark.llm.components import components
from tidemark.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, v=3000):
    return [f"w{rng.randrange(v)}" for _ in range(n)]


def edited(rng, words, rate):
    return [f"e{rng.randrange(10**6)}" if rng.random() < rate else w for w in words]


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(texts, k, percent):
    sets = {i: shingles(t, k) for i, t in texts}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    inverse = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            inverse[g].add(i)
    for a, b in {p for m in inverse.values() for p in combinations(sorted(m), 2)}:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus():
    rng = random.Random(11)
    base = [prose(rng, n) for n in (3, 8, 40, 150, 150, 700)]
    texts = [None, "", " \t", "One two", "one TWO", "one two three", "same words here", "Same  words\nhere"]
    for b in base:
        texts += [" ".join(edited(rng, b, r)) for r in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2) for _ in range(3)]
    chain = prose(rng, 120)
    for i in range(12):  # each near the next, the ends far apart
        texts.append(" ".join(chain))
        chain = chain[3:] + prose(rng, 3)
    common_line = " ".join(prose(rng, 50))
    texts += [common_line + " " + " ".join(prose(rng, rng.choice([5, 20, 60]))) for _ in range(60)]
    texts += [" ".join(edited(rng, base[3], 0.035)) for _ in range(120)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("k, percent", [(4, 85), (5, 80)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "BUCKET", 20)
    monkeypatch.setattr(ngram_join, "COMMON_KEY", 8)
    texts = corpus()
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in texts], "doc_id long, text string, c long, component_id long")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(df, k, percent).collect()}
    want = brute_components(texts, k, percent)
    assert got == want and len(set(want.values())) < len(texts) - 20


def test_near_duplicates_of_odd_tables(spark):
    rows = [(1, "a b c d e f", "en", "s", 1), (1, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1), (None, None, None, None, None), (3, "A B C D E F", "en", "s", 1), (4, "x", None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    kept = ngram_join.keep_one(df)
    # A row repeated whole, copies without an id and copies under another id go; rows without words are copies of nothing.
    assert kept.columns == df.columns and sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == [(0, ""), (1, "a b c d e f"), (4, "x")]
    assert ngram_join.ngram_join(df.limit(0)).collect() == [] and ngram_join.keep_one(df.limit(0)).collect() == []
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in ngram_join.ngram_join(df).collect())
    assert got == [(0, 0, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (3, 2, 1), (4, 1, 4)]


def test_rows_without_ids_and_rows_of_one_id(spark):
    rng = random.Random(5)
    a, b = prose(rng, 80), prose(rng, 80)
    near = [" ".join([*x[:70], "other", *x[71:]]) for x in (a, b)]
    rows = [(None, " ".join(a), 1, "p"), (None, near[0], 2, "q"), (7, " ".join(b), 3, "r"), (7, " ".join(prose(rng, 50)), 4, "s"), (9, near[1], 5, "t"), (None, " ", 6, "u"), (None, " ", 6, "u")]
    df = spark.createDataFrame(rows, "doc_id int, text string, row_hash long, `_salt.x` string")
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.ngram_join(df).collect()]
    assert sorted(got, key=str) == sorted([(None, None)] * 4 + [(7, 7), (7, 7), (9, 7)], key=str)
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns and sorted(r["row_hash"] for r in kept.collect()) in ([1, 3, 4, 6, 6], [2, 3, 4, 6, 6])


def test_large_groups_are_dealt(spark, monkeypatch):
    """Keys, stars, classes and components of many rows, each part of them small."""
    monkeypatch.setattr(common, "KEY_ROWS", 7)
    monkeypatch.setattr(common, "BITMAP_WORDS", 16)
    monkeypatch.setattr(ngram_join, "BUCKET", 16)
    rng = random.Random(6)
    base, other = prose(rng, 60), prose(rng, 60)
    texts = [" ".join(base)] * 60 + [" ".join(edited(rng, base, 0.01)) for _ in range(90)] + [" ".join(edited(rng, other, 0.06)) for _ in range(70)]
    texts = list(enumerate(texts))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(spark.createDataFrame(texts, "doc_id long, text string"), 4, 85).collect()}
    assert got == brute_components(texts, 4, 85)


@given(st.integers(1, 400), st.integers(0, 60), st.sampled_from([80, 85, 90]), st.integers(0, 10**6))
@settings(max_examples=150, deadline=None)
def test_linked_sets_share_a_key(n, change, percent, seed):
    rng = np.random.default_rng(seed)
    h = common.mix(np.arange(n + change, dtype=np.uint64) + np.uint64(seed * 1000))
    a, b = np.sort(h[:n]), np.sort(h[min(change, n - 1) : n + int(rng.integers(0, change + 1))])
    both = len(np.intersect1d(a, b))
    if 100 * both < percent * (len(a) + len(b) - both):
        return
    bands = ngram_join.size_bands(2000, percent)
    keys = []
    for s in (a, b):
        i = int(np.searchsorted(bands, len(s), side="right")) - 1
        mine = set(ngram_join._band_keys(s, i, bands[i + 1], percent)[0].tolist())
        if len(s) * 100 >= bands[i + 1] * percent:
            mine |= set(ngram_join._band_keys(s, i + 1, bands[i + 2], percent)[0].tolist())
        keys.append(mine)
    assert keys[0] & keys[1]


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (5, 4)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("limit", [0, 10**6])
def test_components_of_few_and_many_links(spark, monkeypatch, limit):
    """Few links take one table; both ways give the same."""
    made = []
    monkeypatch.setattr(components_module, "DRIVER_LINKS", limit)
    monkeypatch.setattr(components_module, "written", lambda df, name: made.append(name) or common.written(df, name))
    rng = random.Random(4)
    chain = rng.sample(range(10**15, 10**15 + 10**6), 60)
    links = [*zip(chain, chain[1:], strict=False), *((-5, x) for x in range(30)), *((rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120))]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {x: x for pair in links if pair[0] != pair[1] for x in pair}
    for _ in links:
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want and (made == ["components"]) == bool(limit)


def _counted(monkeypatch):
    """Names and row counts of the tables that are written from now on."""
    made, write = [], common.written

    def counted(df, name):
        table = write(df, name)
        made.append((name, table.count()))
        return table

    monkeypatch.setattr(common, "written", counted)
    return made


def test_keys_of_the_same_classes_count_once(spark, monkeypatch):
    """Texts that nearly link share many keys, yet meet once, and only those of near sketches have their texts fetched."""
    rng = random.Random(8)
    texts = []
    for _ in range(5):
        base = prose(rng, 400)
        texts += [" ".join(base), " ".join([*base[:280], *prose(rng, 120)]), " ".join([*base[:150], *prose(rng, 250)])]
    a = prose(rng, 300)
    texts = list(enumerate([*texts, " ".join(a), " ".join([*a[:290], *prose(rng, 10)])]))
    made = _counted(monkeypatch)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_components(texts, 5, 80)
    # A few sets of classes to each group of three, some with classes of other groups that have an empty block too; one for the pair.
    assert 12 <= dict(made)["members"] <= 80
    assert sum(n for name, n in made if name == "texts") == 2


@pytest.mark.parametrize("seed", range(8))
def test_empty_blocks_have_keys_beyond_the_slack_only(seed):
    """Sets with slack + 1 equal blocks share a key, though all of these be empty and each set have other empty blocks."""
    rng = np.random.default_rng(seed)
    bands = ngram_join.size_bands(2000, 80)
    band = len(bands) - 4
    most, slack = ngram_join.block_count(bands[band + 1], 80)
    p = most + 1 + slack
    blocks = rng.permutation(p)
    equal, mine, other = blocks[: slack + 1], blocks[slack + 1 : slack + 4], blocks[slack + 4 : slack + 9]
    keys = []
    for empty in (np.concatenate((equal, mine)), np.concatenate((equal, other))):
        filled = np.setdiff1d(np.arange(p), empty)
        high = ((filled.astype(np.uint64) << np.uint64(32)) // np.uint64(p) + np.uint64(2)) << np.uint64(32)
        got, left = ngram_join._band_keys(np.sort(high + rng.integers(0, 1 << 32, len(filled), dtype=np.uint64)), band, bands[band + 1], 80)
        assert left < 0 and len(got) == p - slack
        keys.append(set(got.tolist()))
    assert keys[0] & keys[1]


def test_slack_leaves_out_the_most_common_keys(spark):
    often = spark.createDataFrame([(10 * c + i, c, 100 - i, 1 + (i == 1)) for c in (1, 2, 3) for i in range(5)], "key long, cid long, m long, times long")
    classes = spark.createDataFrame([(1, 3), (2, 1), (3, -1)], "cid long, spare int")
    # Keys of 1, 2, 1, 1, 1 blocks in this order; a slack of 3 makes up for the first two.
    assert sorted(r["key"] for r in ngram_join._without_slack(often, classes).collect()) == [12, 13, 14, 21, 22, 23, 24, 30, 31, 32, 33, 34]


@pytest.mark.parametrize("bucket", [1024, 16])
def test_near_pairs_of_many_common_keys_count_once(spark, monkeypatch, bucket):
    """Edited copies, most of them just below the threshold of each other, meet in nearly all of their blocks."""
    monkeypatch.setattr(ngram_join, "COMMON_KEY", 8)
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    rng = random.Random(9)
    base, other = prose(rng, 145), prose(rng, 40)
    texts = [" ".join(edited(rng, base, rng.choice([0.01, 0.03]))) for _ in range(60)] + [" ".join(edited(rng, other, 0.02)) for _ in range(20)]
    texts = list(enumerate(texts))
    made = _counted(monkeypatch)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == brute_components(texts, 5, 80)
    near, pairs = (sum(n for name, n in made if name == x) for x in ("near", "pairs"))
    assert 0 < near <= 4 * pairs


def test_sketches_of_several_widths(spark):
    """Each two are compared as the shorter is; one short sketch among the rows doesn't blur the others."""
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(1, 1 << 62, n, dtype=np.uint64)) for n in (12, 900, 900, 900)]
    sets.append(np.unique(np.concatenate((sets[1][:880], rng.integers(1, 1 << 62, 20, dtype=np.uint64)))))
    rows = [(0, i, i, len(s), ngram_join._bits(s)) for i, s in enumerate(sets)]
    for order in (rows, rows[::-1], rows[2:] + rows[:2]):
        assert list(ngram_join._key_pairs(order, 80, False)) == [(1, 4)]
    assert list(ngram_join._key_pairs([(i % 2, *r[1:]) for i, r in enumerate(rows)], 80, False)) == [(1, 4)]


def test_tasks_give_memory_back():
    pins = []

    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    def work(batches):
        held = [np.ones(6000) for _ in batches for _ in range(3000)]
        pins.append(np.ones(6000))  # above the others, so the heap can't shrink from its end
        yield len(held)

    before = resident()
    assert list(common.lean(work)(iter([1]))) == [3000]
    assert resident() - before < 50 << 20


def test_shuffle_files_of_a_written_table_go_with_it(spark):
    store = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    count = lambda: sum(store.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(store.getAllFiles().size()))
    had, before = spark.conf.get(common.SHUFFLES_GO, None), count()
    grouped = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()  # kept, so no garbage collection helps
    table = common.written(grouped, "grouped")
    for _ in range(50):
        if count() <= before:
            break
        time.sleep(0.1)
    assert count() <= before and spark.conf.get(common.SHUFFLES_GO, None) == had and table.count() == 100
    assert common.written(grouped, "again").count() == 100


def leaks(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_decontamination(spark):
    rng = random.Random(8)
    items = [(i, " ".join(prose(rng, rng.randrange(15, 60)))) for i in range(30)] + [(50, "one two"), (51, None), (None, "x y z"), (52, "short but rare")]
    docs, want = [(900, None), (901, ""), (None, "nothing")], set()
    for i in range(200):
        body = prose(rng, rng.randrange(5, 300))
        if i % 3 == 0:
            item, text = items[i % 30]
            words = text.upper().split()
            kind = i % 4
            part = words if kind == 0 else [w if rng.random() > 0.15 else "new" for w in words] if kind == 1 else [x for w in words for x in ([w, "so"] if rng.random() < 0.1 else [w])] if kind == 2 else [w + "," for w in words if rng.random() > 0.1]
            body[len(body) // 2 : len(body) // 2] = part
            want.add((i, item))
        docs.append((i, " ".join(body)))
    docs += [(1000 + i, docs[3][1]) for i in range(50)]  # a leak copied often keeps its seeds
    want |= {(1000 + i, items[0][0]) for i in range(50)}
    got = leaks(spark, docs, items)
    assert set(got) == want
    for (i, item), r in got.items():
        words = decontaminate.plain_words(dict(docs)[i])[r["first_word"] : r["end_word"]]
        assert set(words) & set(dict(items)[item].split()) and len(words) < 2 * len(dict(items)[item].split())


def test_parts_of_items(spark):
    item = " ".join(f"q{j}" for j in range(60))
    docs = [(n, "before " + " ".join(item.split()[20 : 20 + n]) + " after that") for n in (5, 12, 13, 30)]
    assert set(leaks(spark, docs, [(1, item)])) == {(13, 1), (30, 1)}


def test_short_items_of_common_words(spark):
    items = [(1, "what is the capital of the country"), (2, "which of the two cities is the older one"), (3, "is it so")]
    clean = ["we asked what is the best way of the capital", "he knows which of the two is right and what is the cost", "it is so that the country of the capital"]
    leaked = ["well what is the capital of the country he said", "which of the two cities is the older one", "tell me is it so or not"]
    docs = list(enumerate(clean)) + [(10 + i, t) for i, t in enumerate(leaked)]
    assert set(leaks(spark, docs, items)) == {(10, 1), (11, 2), (12, 3)}


def test_seeds_of_each_part_and_of_short_items(spark):
    rng = random.Random(4)
    for n in (20, 60, 400):
        rate = np.array([rng.choice([1e-5, 1e-6, 1e-4]) for _ in range(n)])
        kept = set(decontaminate.kept_seeds(rate).tolist())
        assert all(kept & set(range(i, i + decontaminate.WINDOW - 2)) for i in range(n - decontaminate.WINDOW + 3))
    common_words = "the of and to in that it was".split()
    item = " ".join(rng.choice(common_words) for _ in range(60))
    filler = [(1000 + i, " ".join(rng.choice([*common_words, f"w{rng.randrange(3000)}"]) for _ in range(200))) for i in range(300)]
    parts = [(i, "yes " + " ".join(item.split()[i : i + 13]) + " no") for i in range(48)]
    assert {(i, 1) for i in range(48)} <= set(leaks(spark, parts + filler, [(1, item)]))
    assert set(leaks(spark, [(1, "it is forty two then"), (2, "forty and two"), (3, "a kiwi."), (4, None)], [(1, "Forty-two"), (2, "kiwi"), (3, "")])) == {(1, 1), (3, 2)}


def test_decontamination_of_odd_tables(spark, monkeypatch):
    items = [(i, " ".join(f"q{i}x{j}" for j in range(12))) for i in range(5)] + [(7, "zwei worte"), (8, "eins"), (9, "la " * 30)]
    docs = [(i, f"before {t} after") for i, t in items] + [(0, f"before {items[0][1]} after"), (None, f"x {items[1][1]}"), (11, None), (12, "la " * 5000), (13, "eins zwei worte")]
    here = spark.createDataFrame(docs, "doc_id long, text string")
    rows = lambda: sorted(map(str, decontaminate.contaminated(here, spark.createDataFrame(items, "item_id long, text string")).collect()))
    local = rows()
    monkeypatch.setattr(decontaminate, "LOCAL_BYTES", 0)  # seeds and items as tables
    monkeypatch.setattr(common, "KEY_ROWS", 3)
    assert rows() == local and len(local) == 5 + 3 + 1 + 1 + 1 + 2
    assert leaks(spark, docs, []) == {} and leaks(spark, [], items) == {}


def test_uncontaminated_rows(spark):
    leak = " ".join(f"q{j}" for j in range(20))
    rows = [(1, f"a {leak} b", 1), (1, "clean text", 2), (None, f"c {leak}", 3), (None, "clean", 4), (2, None, 5), (3, leak, 6), (3, leak, 7), (4, "other", 8), (4, "other", 8)]
    df = spark.createDataFrame(rows, "doc_id int, text string, row_hash int").withColumn("item_id", F.lit(1))
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    kept = decontaminate.keep_uncontaminated(df, items)
    assert kept.columns == df.columns and sorted(r["row_hash"] for r in kept.collect()) == [2, 4, 5, 8, 8]
    assert decontaminate.keep_uncontaminated(df.limit(0), items).collect() == [] and decontaminate.keep_uncontaminated(df, items.limit(0)).count() == len(rows)


def test_seeds_find_what_all_pairs_find():
    """Every document against every item by alignment alone, on whole tables: the seeds find nine in ten of those pairs at least."""
    docs, items = (pq.read_table(f"/root/testdata/sf0.001/{t}.parquet", columns=c) for t, c in (("documents", ["text"]), ("benchmark", ["text"])))
    h, at = decontaminate.words_of(docs["text"].combine_chunks())
    texts = [h[at[i] : at[i + 1]] for i in range(len(docs))]
    hi, ai = decontaminate.words_of(items["text"].combine_chunks())
    mine = [hi[ai[i] : ai[i + 1]] for i in range(len(items))]
    words, counts = np.unique(h, return_counts=True)
    share = dict(zip(words.tolist(), (counts / len(h)).tolist(), strict=True))
    found = {k: [] for k in (1, 2, 3)}
    for i, w in enumerate(mine):
        k, seeds, places = decontaminate.seeds_of(w, np.array([share.get(x, 0.0) for x in w.tolist()]))
        found[k] += [(s, i, p) for s, p in zip(seeds.tolist(), places.tolist(), strict=True)]
    seeds = {k: tuple(np.array(x, t) for x, t in zip(zip(*sorted(v), strict=True), (np.uint64, np.int64, np.int64), strict=True)) if v else (np.zeros(0, np.uint64),) * 3 for k, v in found.items()}
    block = decontaminate.Items(list(range(len(mine))), mine, seeds)
    by_seeds = {(d, i) for d, t in enumerate(texts) for i, *_ in decontaminate.matches(t, block, decontaminate.LEAST)}
    rng = random.Random(1)
    edits = [(w, [x if rng.random() > 0.2 else np.uint64(rng.getrandbits(60)) for x in w]) for w in mine]
    texts += [np.array([*texts[i % 50][:30], *e, *texts[i % 50][:30]], np.uint64) for i, (_, e) in enumerate(edits)]
    by_seeds |= {(d, i) for d, t in enumerate(texts) if d >= len(docs) for i, *_ in decontaminate.matches(t, block, decontaminate.LEAST)}
    pairs = [(d, i) for d in range(len(texts)) for i in range(len(mine)) if d - len(docs) == i or (d, i) in by_seeds or (d < len(docs) and len(np.intersect1d(texts[d], mine[i])) >= 6)]
    all_pairs = {(d, i) for d, i in pairs if decontaminate.align(mine[i], texts[d])[0] / (2 * len(mine[i])) >= decontaminate.bar(len(mine[i]), decontaminate.LEAST)}
    assert len(all_pairs) >= 40 and len(by_seeds & all_pairs) >= 0.9 * len(all_pairs)


def naive_alignment(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 1, new[j] - 1))
        row = new
        best = max(best, *row)
    return best


@given(st.lists(st.integers(0, 5), min_size=1, max_size=25), st.lists(st.integers(0, 5), min_size=1, max_size=40))
@settings(max_examples=150, deadline=None)
def test_alignment(a, b):
    score, lo, hi = decontaminate.align(np.array(a), np.array(b))
    assert score == naive_alignment(a, b) == (naive_alignment(a, b[lo:hi]) if hi > lo else 0)


WORDS = st.text(alphabet="ab'sStTrReEvVlLmMdD  \n\t.,!12éß中٣😀\x1d …", max_size=40)


@pytest.fixture(scope="module")
def encoder():
    return token_store.Encoder(tokenizer_path(), most=300, slot_bits=6)


@given(st.lists(WORDS, max_size=12))
@settings(max_examples=150, deadline=None)
def test_encoder_is_the_library(encoder, texts):
    ids, sizes = encoder(texts)
    parts = np.split(ids, np.cumsum(sizes)[:-1]) if texts else []
    assert [p.tolist() for p in parts] == [encoder.tok.encode(t, add_special_tokens=False).ids for t in texts]


@given(st.integers(0, 4), st.integers(0, 32), st.integers(0, 10**6))
@settings(max_examples=80, deadline=None)
def test_blocks(blocks, bits, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 1 << bits, blocks * token_store.BLOCK, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(len(ids)) < 0.03] = 0xFFFFFFFF
    raw, starts = token_store.pack_blocks(ids) if blocks else (b"", np.zeros(0, np.int64))
    assert (token_store.unpack_blocks(raw, starts) == ids).all() if blocks else True


def test_file(tmp_path):
    rng = np.random.default_rng(1)
    out = token_store.Writer(open(tmp_path / "x", "wb"))
    parts = [rng.integers(0, 50000, n).astype(np.uint32) for n in (1, 0, 255, 257, 5000, 3)]
    for lo in (0, 3):
        part = parts[lo : lo + 3]
        out.add(np.arange(lo, lo + 3), np.ones(3, np.int64), np.array([len(p) for p in part]), np.concatenate(part))
    out.close()
    for step in (1, 4096):
        got = list(token_store.read_file(pa.OSFile(str(tmp_path / "x")), step))
        assert np.concatenate([ids for _, _, ids in got]).tolist() == np.concatenate(parts).tolist()
        assert np.concatenate([b for _, b, _ in got]).tolist() == [0, 1, 1, 256, 513, 5513]
    with pytest.raises(ValueError):
        next(token_store.read_file(pa.BufferReader(io.BytesIO(b"x" * 100).read())))


def test_token_files(spark, encoder):
    rng = random.Random(2)
    texts = [(i, rng.choice([None, "", "plain text " * 50, "<|endoftext|>", " ".join(prose(rng, 400))])) for i in rng.sample(range(1000), 60)] + [(5000, "same"), (5000, "same")]
    df = spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit("clash")).repartition(3)
    got = sorted(token_store.token_store(df, tokenizer_path()).collect(), key=lambda r: (r["doc_id"], r["start"]))
    at = 0
    for r, (i, t) in zip(got, sorted(texts, key=lambda x: x[0]), strict=True):
        ids = [*encoder.tok.encode(t or "", add_special_tokens=False).ids, token_store.END_ID]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert token_store.token_store(df.limit(0), tokenizer_path()).collect() == []
    nulls = token_store.token_store(spark.createDataFrame([(None, "a"), (1, None)], "doc_id long, text string"), tokenizer_path()).collect()
    assert sorted((r["doc_id"] or 0, r["start"]) for r in nulls) == [(0, 0), (1, 2)]


BAD = ["zorbling", "quaxety", "frimblor", "wugnuts"]


def toxic_corpus(n=1200):
    rng = random.Random(9)
    syl = ["the", "an", "er", "in", "on", "at", "re", "ti", "es", "or", "is", "it", "al", "ar", "en"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syl) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(10, 200))]
        bad = i % 6 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = toxic_corpus()
    return toxicity.fit([t for _, t, _ in rows], [y for *_, y in rows])


def scores(model, texts):
    return model.score_texts(texts, model.tables())


def test_gaps_and_insertions_are_met(model):
    hidden = ["z o r b l i n g", "z.o.r.b.l.i.n.g", "zorrbling", "zorxbling", "ZORBLING!!", "fr-imb-lor", "frimmblor", "quaxxety", "wugnutts"]
    clean = ["the inning ", "al terenes on the ations", "", "a b c d"]
    assert (scores(model, [f"the {x} an" for x in hidden]) >= 0.3).all() and (scores(model, clean) < 0.3).all()


def subsequences(codes):
    """All subsequences of three and four letters that span six at most, with their weights, by definition."""
    found = defaultdict(float)
    for k in (3, 4):
        for places in combinations(range(len(codes)), k):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN and places[0] < len(codes) - toxicity.SPAN:
                found[tuple(int(codes[p]) for p in places)] += toxicity.DECAY**span
    return found


def test_folded_weights_are_the_kernel(model):
    """The decision on a sentence is a weighted sum of kernels with the landmarks, computed here by definition."""

    def number(u):
        n = 0
        for c in u:
            n = n * toxicity.A + c
        return n + (toxicity.A**3 if len(u) == 4 else 0)

    def phi(codes):
        norm = (len(codes) - toxicity.SPAN + 1) ** 0.5
        return {u: v * model.rare[number(u)] / norm for u, v in subsequences(codes).items()}

    marks = [(phi(codes), share) for codes, share in model.marks]
    for text in ("the zorbling an", "theater ations", "fr imblorr is there"):
        words = toxicity.words_of([text])
        codes = toxicity._sentence(words, 0)
        mine = phi(codes)
        want = sum(share * sum(v * mark.get(u, 0.0) for u, v in mine.items()) for mark, share in marks)
        assert toxicity.sentence_scores(words, *model.tables())[0][0] == pytest.approx(want, abs=1e-3)


def test_sentences():
    w = toxicity.words_of(["a1 bb cc dd ee ff", "", "xx yy"])
    first, last, text = toxicity.sentences(w)
    assert (first.tolist(), last.tolist(), text.tolist()) == ([0, 1, 2, 6], [4, 5, 6, 8], [0, 0, 0, 2])


def test_held_out_labels_of_the_given_tables():
    docs, labels = (pq.read_table(f"/root/testdata/sf0.1/{t}.parquet", columns=c).to_pylist() for t, c in (("documents", ["doc_id", "text"]), ("labels", ["doc_id", "toxic"])))
    toxic = {r["doc_id"]: r["toxic"] for r in labels}
    rows = [(r["text"] or "", toxic[r["doc_id"]], zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in docs if r["doc_id"] in toxic]
    clean = [r for r in rows if not r[1] and not r[2]]
    learnt = [r for r in rows if r[1] and not r[2]] + clean[:2400]
    found = toxicity.fit([t for t, *_ in learnt], [y for _, y, _ in learnt], len(clean) / 2400)
    held = [r for r in rows if r[2]]
    said, y = scores(found, [t for t, *_ in held]) >= 0.3, np.array([y for _, y, _ in held])
    assert (said & (y == 1)).sum() >= 0.9 * (y == 1).sum() and (said & (y == 1)).sum() >= 0.9 * said.sum()


def test_training_is_bounded(spark):
    docs = spark.createDataFrame([(i, "x" * (10 + i)) for i in range(200)] + [(0, "y" * 500)] * 3 + [(None, "z")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    rows, weight = toxicity.sample(docs, labels, 30, 40, 1 << 20)
    assert [rows.filter(f"y = {y}").count() for y in (0, 1)] == [40, 30] and 0.5 < weight < 1
    few = toxicity.sample(docs, labels, 30, 40, 1000)[0].collect()
    assert sum(len(r["text"]) for r in few) <= 1000 and {r["y"] for r in few} == {0, 1} and all(len(r["text"]) < 300 for r in few)
    assert toxicity.sample(docs, labels.filter("toxic = 1"), 30, 40, 1000)[0] is None


def test_toxicity_held_out(spark):
    rows = toxic_corpus()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows] + [(5000, None, None, None, None), (None, "", None, None, 0)], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows] + [(None, 1, 1), (3, 1, None), (6, 1, 1)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {i: y for i, _, y in rows}
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in truth)
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.97
    assert got[5000]["predicted"] == 0 and 0 <= got[5000]["score"] < 0.3
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(not r["predicted"] for r in got.values())
    none = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) + 2 and all(r["score"] == 0 for r in none)
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_pipeline(spark):
    import corpus_pipeline

    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(spark, docs, path), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    out = corpus_pipeline.STAGES[-1][1](spark, docs, path)
    assert out.count() == docs.count()


def test_pipeline_against_brute_force(spark, tmp_path):
    """Planted toxic texts, near copies and test items, each stage's decisions computed plainly, down to the token files."""
    import duckdb

    import corpus_pipeline

    rng = random.Random(21)
    rows = [(i, t, "en", "abc"[i % 3], len(t)) for i, t, _ in toxic_corpus(900)]
    bad = {i for i, _, y in toxic_corpus(900) if y}
    base = [prose(rng, 120) for _ in range(12)]
    items = [(i, " ".join(prose(rng, 25))) for i in range(5)]
    copies = [" ".join(edited(rng, b, r)) for b in base for r in (0, 0, 0.01, 0.03, 0.3)]
    leaks_ = [" ".join([*prose(rng, 60), items[i % 5][1], *prose(rng, 60)]) for i in range(15)]
    rows += [(5000 + i, t, "en", "ab"[i % 2], len(t)) for i, t in enumerate(copies + leaks_)] + [(7000, None, None, None, None), (7001, "", "en", "a", 0)]
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in bad)) for i in range(900)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    texts = {i: t for i, t, *_ in rows if i not in bad}
    least = {}
    for i, (n, c) in brute_components(list(texts.items()), 5, 80).items():
        least[i] = i if not n else c
    kept = [r for r in rows if r[0] in texts and least[r[0]] == r[0]]
    kept = [r for r in kept if not any(naive_alignment(decontaminate.plain_words(t), decontaminate.plain_words(r[1] or "")) >= 0.4 * 2 * len(t.split()) for _, t in (items if r[0] >= 5000 else []))]
    assert len(bad) == 150 and len(kept) < len(rows) - 150 - 30
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", kept)
    taken = {r[0]: r[1] // r[2] for r in con.execute(f"SELECT doc_id, taken, size FROM ({mixing.ORACLE}) WHERE taken > 0").fetchall()}
    tok, want, at = token_store.Encoder(tokenizer_path()).tok, [], 0
    for i, t, *_ in sorted((r for r in kept if r[0] in taken), key=lambda r: r[0]):
        ids = [*tok.encode(t, add_special_tokens=False).ids, token_store.END_ID]
        for _ in range(taken[i]):
            want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            at += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == want


def test_other_tokenizers_are_the_librarys():
    from tokenizers import Tokenizer

    spec = json.loads(Tokenizer.from_file(tokenizer_path()).to_str())
    assert token_store._splits_as_here(spec) and not token_store._splits_as_here(spec | {"normalizer": {"type": "NFC"}})
    assert not token_store._splits_as_here(spec | {"pre_tokenizer": spec["pre_tokenizer"] | {"add_prefix_space": True}}) and not token_store._splits_as_here(spec | {"pre_tokenizer": None})
    e = token_store.Encoder(tokenizer_path())
    texts = ["plain text's", "", "<|endoftext|> x"]
    usual = e(texts)
    e.plain = True
    assert [a.tolist() for a in e(texts)] == [a.tolist() for a in usual]


def test_failed_attempts_leave_no_files(spark, tmp_path):
    (tmp_path / "part-000000-99.pfr").write_bytes(b"half")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    manifest = token_store.write_tokens(df, str(tmp_path), tokenizer_path())
    assert {p.name for p in tmp_path.iterdir()} == {r["name"] for r in manifest.collect()} and token_store.read_tokens(manifest, str(tmp_path)).count() == 2


def test_many_small_files_start_few_tables_and_tasks(spark, tmp_path, monkeypatch):
    store = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    count = lambda: sum(store.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(store.getAllFiles().size()))
    tables = []
    monkeypatch.setattr(common, "scratch_path", lambda s, name, f=common.scratch_path: tables.append(name) or f(s, name))
    wanted = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    had = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        df = spark.createDataFrame([(i, f"text {i}") for i in range(2000)], "doc_id long, text string")
        before = count()
        manifest = token_store.write_tokens(df, str(tmp_path), tokenizer_path())
        for _ in range(50):
            if count() <= before:
                break
            time.sleep(0.1)
        assert not tables and count() <= before and len(list(tmp_path.iterdir())) == manifest.count() > 20
        read = token_store.read_tokens(manifest, str(tmp_path))
        assert read.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
        rows = sorted(read.collect())
        assert [r["doc_id"] for r in rows] == list(range(2000)) and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:], strict=False)) and rows[0]["start"] == 0
        monkeypatch.setattr(token_store, "READ_IDS", 1)
        assert token_store.read_tokens(manifest, str(tmp_path)).rdd.getNumPartitions() == manifest.count()
    finally:
        for name, value in had.items():
            spark.conf.set(name, value)


def test_pieces_in_the_sorted_table(monkeypatch):
    monkeypatch.setattr(token_store, "RECENT", 20)
    rng, e = random.Random(3), token_store.Encoder(tokenizer_path(), most=700, slot_bits=3)
    for _ in range(40):
        texts = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(30))) for _ in range(5)]
        ids, sizes = e(texts)
        assert [p.tolist() for p in np.split(ids, np.cumsum(sizes)[:-1])] == [e.tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(e.keys) + len(e.recent) == e.pieces == len({*e.keys.tolist(), *e.recent}) and len(e.keys) and len(e.recent) <= 20


def test_encoder_stays_small():
    def resident():
        common.give_back()
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096

    e = token_store.Encoder(tokenizer_path())
    e(["x y"])
    before = resident()
    for lo in range(0, 400_000, 4000):
        e([" ".join("".join(chr(97 + i // 26**k % 26) for k in range(5)) for i in range(lo, lo + 4000))])
    assert resident() - before < 45 << 20


def test_training_rows_start_no_other_workers(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    rows, _ = toxicity.sample(spark.createDataFrame(docs.toArrow()), spark.createDataFrame(labels.toArrow()), 5, 5, 1 << 20)
    assert "LogicalRDD" not in rows._jdf.queryExecution().optimizedPlan().toString() and 4 <= rows.count() <= 10


def _edits(rng, words, kind):
    new = lambda: np.uint64(rng.getrandbits(60))
    if kind.startswith("random"):
        return [w if rng.random() > int(kind[7:]) / 100 else new() for w in words]
    if kind == "every third":
        at = rng.randrange(3)
        return [new() if i % 3 == at else w for i, w in enumerate(words)]
    if kind == "deleted":
        at = rng.randrange(3)
        return [w for i, w in enumerate(words) if i % 3 != at]
    if kind == "inserted":
        at = rng.randrange(3)
        return [x for i, w in enumerate(words) for x in ([w, new()] if i % 3 == at else [w])]
    return [x for w in words for x in rng.choice([[w], [w], [w], [new()], [], [w, new()]])]


@pytest.mark.parametrize("kind", ["random 20", "random 30", "random 40", "every third", "deleted", "inserted", "mixed"])
def test_recall_of_edited_items(kind):
    """Edited copies of items of 3 to 200 words in documents of sf0.01, against alignment of all of them with all items: an item is aligned wherever it shares as many words as the bar asks for at all."""
    docs, given_items = (pq.read_table(f"/root/testdata/sf0.01/{t}.parquet", columns=["text"]) for t in ("documents", "benchmark"))
    h, at = decontaminate.words_of(docs["text"].combine_chunks())
    rng = random.Random(kind)
    hi, ai = decontaminate.words_of(given_items["text"].combine_chunks())
    mine = [hi[ai[i] : ai[i + 1]] for i in range(len(given_items)) if ai[i + 1] - ai[i] >= 3][:100]
    vocabulary = np.unique(h)
    mine += [np.array(rng.choices(h.tolist() if n % 2 else vocabulary.tolist(), k=n), np.uint64) for n in [*range(3, 30), *range(30, 201, 5)]]
    words, counts = np.unique(h, return_counts=True)
    share = dict(zip(words.tolist(), (counts / len(h)).tolist(), strict=True))
    found = []
    for i, w in enumerate(mine):
        k, seeds, places = decontaminate.seeds_of(w, np.array([share.get(x, 0.0) for x in w.tolist()]))
        assert k == 3
        found += [(s, i, p) for s, p in zip(seeds.tolist(), places.tolist(), strict=True)]
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    block = decontaminate.Items(list(range(len(mine))), mine, {1: none, 2: none, 3: tuple(np.array(x, t) for x, t in zip(zip(*sorted(found), strict=True), (np.uint64, np.int64, np.int64), strict=True))})
    texts = []
    for w in mine:
        d = rng.randrange(len(docs))
        body = h[at[d] : at[d + 1]][:80]
        texts.append(np.array([*body, *_edits(rng, w, kind), *body[::-1]], np.uint64))
    by_seeds = {(d, i) for d, t in enumerate(texts) for i, *_ in decontaminate.matches(t, block, decontaminate.LEAST)}
    all_pairs = set()
    for d, t in enumerate(texts):
        for i, w in enumerate(mine):
            least = decontaminate.bar(len(w), decontaminate.LEAST)
            if np.isin(w, t).sum() >= least * len(w) and decontaminate.align(w, t)[0] / (2 * len(w)) >= least:
                all_pairs.add((d, i))
    assert len(all_pairs) > 50 and len(by_seeds & all_pairs) >= 0.9 * len(all_pairs), (len(by_seeds & all_pairs), len(all_pairs))
