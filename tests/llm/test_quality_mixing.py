"""Quality rules and mixing against plain Python, and on odd tables."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, quality_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def words(text):
    return (text or "").encode().split()


def base(text):
    text = text or ""
    w = words(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if words(x):
            dup += x in seen
            seen.add(x)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def texts():
    rng = random.Random(5)
    vocab = ["the", "of", "é", "x#", "<b>", "a|b", "long word", "!!"]
    found = [None, "", " \n\t ", "a a a a", "x", "l1 b\nl1 b\n \n \nl1 b", "a b c\x0bd a b c"]
    return found + [" ".join(rng.choice(vocab) + rng.choice(["", "", "\n"]) for _ in range(rng.choice([3, 20, 60, 200]))) for _ in range(40)] + ["word " * 5000]


def test_counts(spark):
    rows = [(i, t, None, None, 0) for i, t in enumerate(texts())]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).collect()}
    for i, t, *_ in rows:
        r, want = got[i], base(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, repr(t)[:80]
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r["base_failed"] == failed and r["kept"] == (not failed)


@pytest.mark.parametrize("n, k, rate", [(10, 0, 0.3), (300, 2, 0.02), (5000, 70, 0.02), (100000, 1900, 0.02), (50, 50, 0.5), (20, 1, 0.2)])
def test_binomial_tail(spark, n, k, rate):
    got = spark.range(1).select(quality_rules.binomial_tail(F.lit(n), F.lit(k), rate)).first()[0]
    want = math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(rate) + (n - j) * math.log(1 - rate)) for j in range(k + 1))
    assert got == (1.0 if k >= n * rate else pytest.approx(want, rel=1e-6))


def test_cutoffs_hold_back_without_proof_and_reject_junk(spark):
    rng = random.Random(3)

    def prose(i):
        return " ".join(f"w{rng.randrange(5000)}" for _ in range(80))

    good = [(i, prose(i), "en", "s", 0) for i in range(900)]
    junk = [(1000 + i, " ".join(f"w{rng.randrange(5000)}###" for _ in range(80)), "en", "s", 0) for i in range(60)]
    few = [(2000 + i, " ".join(f"w{rng.randrange(5000)}###" for _ in range(80)), "xx", "s", 0) for i in range(20)]
    docs = spark.createDataFrame(good + junk + few, DOCS)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(900)] + [(1000 + i, 0, 0) for i in range(30)] + [(1, None, 0), (None, 1, 0), (5, 1, 0), (5, 1, 0)], LABELS)
    kept = {r["doc_id"] for r in quality_rules.quality_rules(docs, labels).filter("kept").collect()}
    assert len(kept & set(range(900))) >= 890 and not kept & set(range(1000, 1060)) and set(range(2000, 2020)) <= kept


def _labelled(copies):
    """Two languages of good prose and of junk; ``copies`` documents a text."""
    rng = random.Random(8)
    docs, labels = [], []
    for lang, n in (("en", 700), ("de", 400), (None, 60)):
        for i in range(n):
            junk = i % 5 == 0
            text = " ".join(f"w{rng.randrange(5000)}" + ("##" if junk and rng.random() < 0.8 else "!" * (rng.random() < 0.1)) for _ in range(80))
            for _ in range(copies):
                docs.append((len(docs), text, lang, "s", 0))
                labels.append((len(labels), 0 if junk else 1, 0))
    labels.append((7 * copies, 0, 0))
    return docs, labels


def test_sql_agrees_where_cutoffs_are_proved(spark):
    import duckdb

    docs, labels = _labelled(1)
    d, n = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = quality_rules.quality_rules(d, n)
    con = duckdb.connect()
    con.register("documents", d.toArrow())
    con.register("labels", n.toArrow())
    want = con.sql(quality_rules.oracle()).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.filter("not base_failed and not kept").count() > 100


def test_copies_are_one_trial(spark):
    """A text that fifty documents have proves no more than one: the same cutoffs, and none from few texts."""

    def cutoffs(copies, most=None):
        docs, labels = _labelled(copies)
        counted = quality_rules.text_features(spark.createDataFrame(docs[:most], DOCS).withColumn("stratum", F.coalesce("lang", F.lit(""))).withColumn("text_hash", F.xxhash64("text"))).withColumn("base_failed", F.lit(False))
        return sorted(map(tuple, quality_rules.choose_cutoffs(counted, spark.createDataFrame(labels, LABELS)).collect()), key=str)

    once = cutoffs(1)
    assert cutoffs(3) == once and {r[0] for r in once} == {"en", "de"} and any(x for r in once for x in r[1:])
    assert cutoffs(50, 50 * 20) == []


def waterfill(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, full, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            full.add(s)
            target[s] = 2.0 * sizes[s]
            left -= target[s]


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([0, 1, 5, 30]), None, rng.choice([None, "a", "a", "a", "a", "b", "c", "é", "tiny"] if i < 3000 else ["a"]), 0) for i in range(3300)]
    rows += [(None, "w w", None, "b", 0), (4007, None, None, "empty", 0), (4009, "w w w", None, "a", 0), (4009, "w w w", None, "a", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("h", F.lit(1)).withColumn("size", F.lit("clash"))
    got = mixing.mix(docs).join(docs.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    sizes = defaultdict(int)
    for i, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    want = waterfill(sizes)
    assert len(mixing.mix(docs).collect()) == len(rows)
    taken = defaultdict(int)
    for r in got:
        if r["doc_id"] is None:
            continue
        assert 0 <= r["taken"] <= 2 * r["size"] and r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 35, s


def test_mix_reruns_agree_and_nest(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), None, "s", 0) for i in range(800)], DOCS)

    def chosen(target):
        rows = mixing.mix(docs, spark.createDataFrame([("s", target)], "source string, target double")).filter("taken > 0").collect()
        return {r["doc_id"] for r in rows}

    assert chosen(500.0) == chosen(500.0) and chosen(500.0) < chosen(1500.0)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert mixing.mix(docs).collect() == [] and mixing.mixed(docs).collect() == []
    assert quality_rules.quality_rules(docs, labels).collect() == []


def test_mixed_repeats_rows(spark):
    docs = spark.createDataFrame([(i, "w w w w", "en", "a", 7) for i in range(40)], DOCS)
    got = mixing.mixed(docs)
    assert got.columns == docs.columns and 55 <= got.count() <= 65


def test_mixed_rows(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), "abc"[i % 3], i, "mine", "x") for i in range(300)] + [(5, "", "a", 900, "mine", "x"), (6, None, None, 901, "mine", "x"), (7, "u v", None, 902, "mine", "x"), (None, "q r s", "b", 903, "mine", "x")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n long, copy string, mix_copies string")
    taken = {(r["doc_id"], r["size"], r["target"]): r["taken"] for r in mixing.mix(df).collect()}
    got = mixing.mixed(df)
    kept = got.collect()
    assert got.columns == df.columns and {r["copy"] for r in kept} == {"mine"} and not {r["n"] for r in kept} & {900, 901}
    assert sum(len(r["text"].split()) for r in kept) == sum(r["taken"] for r in mixing.mix(df).collect()) and len(taken) > 290
    assert mixing.mixed(df.limit(0)).collect() == []


def test_null_language_is_a_stratum_of_its_own(spark):
    """Texts of language '' prove a cutoff; those of no language are too few to."""
    clean = "word " * 80
    unique = lambda i, t: " ".join(f"{w}{i}x{j}" for j, w in enumerate(t.split()))
    rows = [(i, unique(i, clean), "", "clash") for i in range(600)] + [(1000 + i, unique(i, clean), None, "clash") for i in range(5)] + [(2000, unique(1, clean).replace(" ", "!#!#!#!#! "), "", "x"), (2001, unique(2, clean).replace(" ", "!#!#!#!#! "), None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, stratum string")
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in rows if i < 2000], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(docs, labels).collect()}
    assert not got[2000]["base_failed"] and not got[2000]["kept"] and got[2001]["kept"] and all(got[i]["kept"] for i in range(600))
