"""Quality rules with risk-controlled cutoffs, in DataFrame expressions only.

Each rule rejects a text whose ratio (symbols, repeated words, repeated lines,
exclamation marks) reaches a cutoff.  The cutoffs are chosen for each stratum
(language) on labelled texts, so that with confidence ``1 - DELTA`` no stratum
loses more than ``ALPHA`` of its good texts:

* a trial is a distinct good text, however many documents have it, as copies
  tell no more than one of them does;
* a cutoff is safe if ``P(Bin(n, ALPHA / rules) <= k)`` is at most the level,
  for k rejected of n good labelled texts (the exact binomial bound);
* the level is ``DELTA`` over all strata and rules (Bonferroni); within a rule
  cutoffs are tested from lenient to strict until the first that isn't safe
  (fixed sequence), so they need no further correction;
* ``ALPHA`` is shared out over the rules, so their union stays within it.

The cutoff grids are fixed beforehand.  A stratum with too few labels to prove
a cutoff keeps its texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

ALPHA, DELTA = 0.08, 0.10
#: rule -> (what is counted, per how many of what, cutoffs in thousandths from lenient to strict)
RULES: dict[str, tuple[str, str, tuple[int, ...]]] = {
    "symbols": ("n_symbols", "n_words", (3000, 2000, 1500, 1000, 750, 500, 400, 300, 250, 200, 150, 100)),
    "repeats": ("n_repeat_words", "n_words", (500, 450, 400, 350, 300, 250, 200, 150, 100, 75, 50)),
    "lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300, 200, 150, 100)),
    "bangs": ("n_bangs", "n_words", (3000, 2000, 1500, 1000, 750, 500, 300, 200, 150, 100)),
}
_SPACES = " \t\n\x0b\x0c\r"
_SPLIT = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that the text has twice or more."""

    def of_windows(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            last = F.size(s) - 1
            twice = F.filter(s, lambda x, i: ((i > 0) & (s[F.greatest(i - 1, F.lit(0))]["h"] == x["h"])) | ((i < last) & (s[F.least(i + 1, last)]["h"] == x["h"])))
            return _let(F.transform(twice, lambda x: x["i"]), lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2)))))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_let(ordered, covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    return F.when(F.size(words) < 4, 0).otherwise(_let(windows, of_windows)).cast("long")


def text_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules use; a null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = F.length(text)
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.translate(x, _SPACES, "") != "")
    words = F.array_remove(F.split(text, _SPLIT, -1), "")
    counts = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    of_lines = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    return docs.withColumns(
        {
            "n_words": counts["n"],
            "word_chars": _without(text, _SPACES).cast("long"),
            "n_symbols": (size - _without(text, "#*$%&|<>")).cast("long"),
            "n_dup_lines": of_lines["d"],
            "n_repeat_words": counts["r"],
            "n_lines": of_lines["n"],
            "n_bangs": (size - _without(text, "!")).cast("long"),
        }
    )


def _ln_factorial(n: Column) -> Column:
    """By Stirling's series above 20: relative error below 1e-13."""
    x = n.cast("double")
    far = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * x * x * x * x * x)
    return F.when(n <= 20, F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))).otherwise(far)


def binomial_tail(n: Column, k: Column, rate: float) -> Column:
    """``P(Bin(n, rate) <= k)`` for k below its mean, else 1, which proves nothing.

    Terms are added downwards from k; those that a double can't add any more
    are left out.
    """
    n, k = n.cast("long"), k.cast("long")
    top = F.exp(_ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k) + k * F.log(F.lit(rate)) + (n - k) * F.log(F.lit(1 - rate)))
    steps = F.least(k, (F.ceil(F.sqrt(k.cast("double"))) * 40 + 200).cast("long"))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("all"))

    def add(acc: Column, i: Column) -> Column:
        j = (k - i).cast("double")
        term = acc["term"] * j / (n.cast("double") - j + 1) * ((1 - rate) / rate)
        return F.struct(term.alias("term"), (acc["all"] + term).alias("all"))

    total = F.aggregate(F.when(steps > 0, F.sequence(F.lit(0).cast("long"), steps - 1)).otherwise(F.array().cast("array<bigint>")), zero, add, lambda acc: acc["all"])
    return F.when(k >= n * F.lit(rate), F.lit(1.0)).otherwise(top * total)


def _reaches(what: str, per: str, cutoff) -> Column:
    return 1000 * F.col(what) >= cutoff * F.col(per)


def choose_cutoffs(counted: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """``stratum`` and a cutoff for each rule, null where none is proved safe.

    A text is good if all labels of all its documents in the stratum say so;
    null labels are left out.  Texts that fail the base rules don't count.
    Those whose ``text_hash`` agree are one text.
    """
    good = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = sorted({c for what, per, _ in RULES.values() for c in (what, per)})
    judged = counted.filter("not base_failed").select("doc_id", "stratum", "text_hash", *counts).join(good, "doc_id")
    seen = judged.groupBy("stratum", "text_hash").agg(F.min("quality").alias("quality"), *(F.first(c).alias(c) for c in counts)).filter("quality = 1")
    tests = [(r, i, c) for r, (_, _, grid) in RULES.items() for i, c in enumerate(grid)]
    sums = [F.sum(_reaches(*RULES[r][:2], F.lit(c)).cast("long")).alias(f"{r}_{i}") for r, i, c in tests]
    by = seen.groupBy("stratum").agg(F.count("*").alias("n"), *sums)
    rows = by.select("stratum", "n", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"{r}_{i}").alias("k")) for r, i, c in tests))).alias("t")).select("stratum", "n", "t.*")
    strata = by.agg(F.count("*").alias("strata"))
    level = F.lit(delta) / (F.col("strata") * len(RULES))
    tried = rows.crossJoin(F.broadcast(strata)).withColumn("safe", binomial_tail(F.col("n"), F.col("k"), alpha / len(RULES)) <= level)
    stop = tried.groupBy("stratum", "rule").agg(F.min(F.when(~F.col("safe"), F.col("i"))).alias("stop"))
    last = tried.join(stop, ["stratum", "rule"]).filter("stop is null or i < stop").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return last.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per document: its counts, ``base_failed``, and ``kept``.

    Base rules: fewer than 50 words, or over half of the words in three-word
    windows that the text repeats.  A null or empty text has no words and
    fails.  A null language is a stratum of its own.  Repeated rows give
    repeated results, an empty table an empty one; without labels no cutoff is
    proved.  Columns but doc_id, text and lang are ignored, whatever their names.
    """
    slim = docs.select("doc_id", F.coalesce(F.concat(F.lit("l:"), "lang"), F.lit("")).alias("stratum"), "text", F.struct(F.xxhash64("text").alias("a"), F.hash("text").alias("b")).alias("text_hash"))
    counted = text_features(slim).drop("text").withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    counted = common.written(counted, "counted")
    cutoffs = common.written(choose_cutoffs(counted, labels, alpha, delta), "cutoffs")
    rules = counted.join(common.checked_broadcast(cutoffs, 64), "stratum", "left")
    bad = F.lit(False)
    for r, (what, per, _) in RULES.items():
        bad = bad | F.coalesce(_reaches(what, per, F.col(r)), F.lit(False))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~bad).alias("kept"))


def oracle() -> str:
    """The same rows in DuckDB's SQL."""
    tests = [(r, i, c) for r, (_, _, grid) in RULES.items() for i, c in enumerate(grid)]
    per = {r: (a, b) for r, (a, b, _) in RULES.items()}
    sums = ", ".join(f"sum(CASE WHEN 1000 * {per[r][0]} >= {c} * {per[r][1]} THEN 1 ELSE 0 END)::BIGINT AS {r}_{i}" for r, i, c in tests)
    firsts = ", ".join(f"any_value({c}) AS {c}" for c in sorted({c for what, p, _ in RULES.values() for c in (what, p)}))
    rows = " UNION ALL ".join(f"SELECT stratum, n, '{r}' AS rule, {i} AS i, {c} AS cutoff, {r}_{i} AS k FROM sums" for r, i, c in tests)
    a = ALPHA / len(RULES)
    bad = " OR ".join(f"coalesce(1000 * {what} >= {r} * {p}, false)" for r, (what, p, _) in RULES.items())
    picks = ", ".join(f"min(cutoff) FILTER (WHERE rule = '{r}') AS {r}" for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce('l:' || lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
      list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
tri AS (SELECT rid, i, (words[i], words[i + 1], words[i + 2]) AS t FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, t) AS c FROM tri) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS r FROM twice, (VALUES (0), (1), (2)) AS v(j) GROUP BY rid),
c AS (SELECT d.doc_id, d.stratum, d.text, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
      (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
      coalesce(r, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, (length(text) - length(replace(text, '!', '')))::BIGINT AS n_bangs
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c),
good AS (SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
trials AS (SELECT stratum, text, {firsts} FROM b JOIN good USING (doc_id) WHERE NOT base_failed GROUP BY stratum, text HAVING min(quality) = 1),
sums AS (SELECT stratum, count(*) AS n, {sums} FROM trials GROUP BY stratum),
rows_ AS ({rows}),
p AS (SELECT *, CASE WHEN k >= n * {a} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1), lambda j:
      exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({a}) + (n - j) * ln(1 - {a})))) END AS tail FROM rows_),
s AS (SELECT *, tail <= {DELTA} / ((SELECT count(*) FROM sums) * {len(RULES)}) AS safe FROM p),
last_ AS (SELECT stratum, rule, min(i) FILTER (WHERE NOT safe) AS stop FROM s GROUP BY stratum, rule),
cut AS (SELECT stratum, {picks} FROM s JOIN last_ USING (stratum, rule) WHERE stop IS NULL OR i < stop GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({bad}) AS kept
FROM b LEFT JOIN cut USING (stratum)"""
