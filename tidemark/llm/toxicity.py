"""Toxicity by a subsequence string-kernel SVM with Nyström landmarks.

The kernel of two sentences counts their common subsequences of three and of
four letters, word edges included, of at most ``SPAN`` characters, each weighted
by ``DECAY`` to the length it spans in either sentence and by how rarely clean
texts have it.  So a word with gaps or with inserted characters stays close to
the word it hides.  A sentence is a run of ``SENTENCE`` words; those of a text
overlap.

Labels are of texts, and of a toxic text few sentences are toxic.  So training
is multiple-instance learning (MI-SVM): the sentences of each toxic text that
the last model finds worst are the toxic ones of the next, against the worst and
some random ones of clean texts.  A first guess comes from the subsequences that
more toxic than clean texts have.  Each model is an SVM on the kernel's Nyström
features for landmark sentences.  Its decision is linear in the subsequences, so
it folds into one weight a subsequence, and a text is scored by summing weights
along it: no kernel is evaluated at scoring time.

A text's score is a logistic function of its worst sentence and of how many of
its sentences lie beyond the margin, fitted on labelled texts.

Training uses a bounded sample of labelled rows (``sample_toxic`` and
``sample_clean``, those of least hash, of ``sample_bytes`` at most).  Scoring
reads every text whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Letter codes: 0 is a word edge, then a-z, frequent accented letters, three for all other letters; the last one is none and has no weight.
LETTERS = " abcdefghijklmnopqrstuvwxyzéèêçüöäßñíóáúàâîôû"
A = len(LETTERS) + 4
SPAN, DECAY = 6, 0.7
GAPS3 = [(x, y) for x in range(1, SPAN) for y in range(x + 1, SPAN)]
GAPS4 = [(x, y, z) for x, y in GAPS3 for z in range(y + 1, SPAN)]
#: Words of a sentence.
SENTENCE = 4
#: Landmark sentences; rounds of choosing sentences anew; the worst sentences that a toxic and a clean text give to training.
LANDMARKS, ROUNDS, WORST = 400, 4, (3, 2)
#: Texts of the sample that are held as letter codes in one run.
_GROUP = 64
_DROP = 255


def _letter_table() -> np.ndarray:
    table = np.full(1 << 16, _DROP, dtype=np.uint8)
    for cp in range(0xD800):
        ch = chr(cp)
        low = ch.lower()[:1]
        if low in LETTERS and not ch.isspace():
            table[cp] = LETTERS.index(low)
        elif ch.isspace() or cp in (0x7C, 0x00):
            table[cp] = 0
        elif ch.isalpha():
            table[cp] = len(LETTERS) + ord(low) % 3
    return table


_TABLE = _letter_table()


@dataclass
class Words:
    """Words of some texts as one run of letter codes: ``edge`` has the place before each word, ``at`` the first word of each text."""

    codes: np.ndarray
    edge: np.ndarray
    at: np.ndarray


def words_of(texts: list[str]) -> Words:
    """Letters only, lowered; white space separates; single letters in a row are one word."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    starts = np.cumsum(sizes) - sizes
    cps = np.frombuffer(("".join(f" {t}" for t in texts)).encode("utf-32-le", "replace"), dtype=np.uint32)
    codes = _TABLE[np.minimum(cps, 0xFFFF)]
    place = np.flatnonzero(codes != _DROP)
    codes = codes[place]
    space = codes == 0
    first = np.flatnonzero(~space & np.concatenate(([True], space[:-1]))) if len(codes) else np.zeros(0, np.int64)
    text = np.searchsorted(starts, place[first], side="right") - 1
    follows = np.concatenate((space[1:], [True])) if len(codes) else space
    keep = ~(space & follows)
    length = np.add.reduceat(~space, first) if len(first) else np.zeros(0, np.int64)
    joined = np.zeros(len(first), dtype=bool)
    joined[1:] = (length[1:] == 1) & (length[:-1] == 1) & (text[1:] == text[:-1])
    keep[first[joined] - 1] = False
    first, text = first[~joined], text[~joined]
    index = np.cumsum(keep) - 1
    return Words(np.concatenate((codes[keep], [0], np.full(SPAN - 1, A - 1))).astype(np.uint8), index[first] - 1, np.searchsorted(text, np.arange(len(texts) + 1)))


def _indexes(codes: np.ndarray) -> Iterator[tuple[int, float, np.ndarray]]:
    """(order, weight, subsequence number at each place) of all subsequences within the span."""
    n = len(codes) - SPAN
    c0 = codes.astype(np.int32)
    c1, c2, c3 = c0 * A, c0 * (A * A), c0 * (A * A * A)
    for x, y in GAPS3:
        yield 3, DECAY ** (y + 1), c2[:n] + c1[x : n + x] + c0[y : n + y]
    for x, y, z in GAPS4:
        yield 4, DECAY ** (z + 1), c3[:n] + c2[x : n + x] + c1[y : n + y] + c0[z : n + z]


def word_scores(words: Words, w3: np.ndarray, w4: np.ndarray) -> np.ndarray:
    """The sum of the weights of all subsequences that start in each word."""
    if not len(words.edge):
        return np.zeros(0)
    n, step = len(words.codes) - SPAN, 1 << 16
    out = np.zeros(n, dtype=np.float32)
    for lo in range(0, n, step):
        part = words.codes[lo : min(lo + step, n) + SPAN]
        for order, weight, idx in _indexes(part):
            out[lo : lo + len(idx)] += np.float32(weight) * (w3 if order == 3 else w4)[idx]
    return np.add.reduceat(out, words.edge).astype(np.float64)


def sentences(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each sentence its first word, the word after its last, and its text: every run of SENTENCE words, or a shorter text whole."""
    text = np.repeat(np.arange(len(words.at) - 1), np.diff(words.at))
    first = np.arange(len(words.edge))
    whole = (first + SENTENCE <= words.at[1:][text]) | (first == words.at[:-1][text])
    first, text = first[whole], text[whole]
    return first, np.minimum(first + SENTENCE, words.at[1:][text]), text


def sentence_scores(words: Words, w3: np.ndarray, w4: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The weights' sum in each sentence over the root of its length; its first word and its text."""
    first, last, text = sentences(words)
    run = np.concatenate(([0.0], np.cumsum(word_scores(words, w3, w4))))
    ends = np.append(words.edge[1:], len(words.codes) - SPAN)
    size = (ends[last - 1] - words.edge[first] + 1) if len(first) else np.ones(0)
    return (run[last] - run[first]) / np.sqrt(size), first, text


def _numbers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and weights of all subsequences that start in some letters (the last SPAN codes only end them)."""
    found = [(i if order == 3 else i + A**3, weight) for order, weight, i in _indexes(codes)]
    return np.concatenate([i for i, _ in found]), np.repeat([w for _, w in found], len(codes) - SPAN)


def _sentence(words: Words, first: int) -> np.ndarray:
    """Letter codes of the sentence that begins with a word, and the SPAN codes after it."""
    text = int(np.searchsorted(words.at, first, side="right")) - 1
    last = min(first + SENTENCE, int(words.at[text + 1]))
    end = words.edge[last] if last < len(words.edge) else len(words.codes) - SPAN
    return words.codes[words.edge[first] : end + SPAN]


def features(codes: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kernel features of a sentence: numbers of its subsequences, sorted, and their values."""
    numbers, weights = _numbers(codes)
    u, inverse = np.unique(numbers, return_inverse=True)
    return u, np.bincount(inverse, weights) * rare[u] / np.sqrt(len(codes) - SPAN + 1)


@dataclass
class Model:
    """Folded weights of subsequences, and the text calibration (bias, worst sentence, log of sentences beyond the margin).

    ``marks`` are the landmark sentences' codes with their shares in the
    decision and ``rare`` the kernel's weights of the subsequences: what the
    weights were folded from.
    """

    number: np.ndarray
    weight: np.ndarray
    bias: float
    text: tuple[float, float, float]
    marks: list[tuple[np.ndarray, float]] = field(default_factory=list)
    rare: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def __getstate__(self) -> dict:
        return self.__dict__ | {"marks": [], "rare": np.zeros(0)}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        w3, w4 = np.zeros(A**3, np.float32), np.zeros(A**4, np.float32)
        three = self.number < A**3
        w3[self.number[three]] = self.weight[three]
        w4[self.number[~three] - A**3] = self.weight[~three]
        return w3, w4

    def text_features(self, words: Words, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """For each text: its worst sentence's margin, at least -2, and log(1 + sentences of positive margin, those that overlap as one)."""
        out = np.zeros((len(words.at) - 1, 2))
        out[:, 0] = -2.0
        scores, _, text = sentence_scores(words, *tables)
        if len(scores):
            margin = scores + self.bias
            start = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
            out[text[start], 0] = np.maximum(np.maximum.reduceat(margin, start), -2.0)
            out[text[start], 1] = np.log1p(np.add.reduceat((margin > 0).astype(float), start) / SENTENCE)
        return np.minimum(out, 6.0)

    def score(self, features: np.ndarray) -> np.ndarray:
        b, x, y = self.text
        return 1 / (1 + np.exp(-np.clip(b + x * features[:, 0] + y * features[:, 1], -30, 30)))

    def score_texts(self, texts: list[str], tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return self.score(self.text_features(words_of(texts), tables))


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; the last column of x is the constant."""
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(rounds):
        on = y * (x @ w) < 1
        xs = x[on] * cost[on, None]
        new = np.linalg.solve(ridge + x[on].T @ xs, xs.T @ y[on])
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + 0.1 * w
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _frequencies(groups: list[Words], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many clean and how many toxic texts have each subsequence."""
    have = np.zeros((2, A**3 + A**4), np.float32)
    last = np.zeros(A**3 + A**4, np.int32)
    n = 0
    for w in groups:
        ends = np.append(w.edge[1:], len(w.codes) - SPAN)
        for lo, hi in zip(w.at[:-1], w.at[1:], strict=True):
            if hi > lo:
                numbers, _ = _numbers(w.codes[w.edge[lo] : ends[hi - 1] + SPAN])
                place = np.arange(len(numbers), dtype=np.int32)
                last[numbers] = place
                have[toxic[n], numbers[last[numbers] == place]] += 1
            n += 1
    return have[0], have[1]


def _first_guess(clean: np.ndarray, bad: np.ndarray, n0: int, n1: int) -> tuple[np.ndarray, np.ndarray]:
    """How rarely clean texts have each subsequence, and a weight for those that more toxic than clean texts have: their deviation beyond three."""
    rare, guess = np.zeros(len(clean), np.float32), np.zeros(len(clean), np.float32)
    for lo in range(0, len(clean), 1 << 18):
        at = slice(lo, lo + (1 << 18))
        few, many = clean[at], bad[at]
        rare[at] = np.maximum(0.0, np.log((n0 + 2.0) / (few + 1.0))) / 5
        share = (few + many + 1) / (n0 + n1)
        z = (many / n1 - few / n0) / np.sqrt(share * np.maximum(1 - share, 1e-9) * (1 / n1 + 1 / n0))
        guess[at] = np.where(z >= 3, np.log1p(np.maximum(z, 0)), 0)
    return rare, guess


def _worst(groups: list[Words], toxic: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> list[list[tuple[int, int, float]]]:
    """The worst sentences of each text, as (group, first word, score), the worst first."""
    found: list[list[tuple[int, int, float]]] = []
    for g, w in enumerate(groups):
        scores, first, text = sentence_scores(w, *tables)
        cuts = np.searchsorted(text, np.arange(len(w.at)))
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            order = lo + np.argsort(-scores[lo:hi], kind="stable")[: WORST[0] if toxic[len(found)] else WORST[1]]
            found.append([(g, int(first[j]), float(scores[j])) for j in order])
    return found


def _distinct(texts: list[str], toxic: list[int]) -> tuple[list[str], np.ndarray]:
    """Texts with words, those whose words are the same once for each label: copies tell nothing new."""
    kept: dict[tuple[bytes, int], str] = {}
    for t, y in zip(texts, toxic, strict=True):
        w = words_of([t])
        if len(w.edge):
            kept.setdefault((w.codes.tobytes(), int(y)), t)
    return list(kept.values()), np.array([y for _, y in kept], dtype=int)


def fit(texts: list[str], toxic: list[int], clean_weight: float = 1.0, landmarks: int = LANDMARKS, seed: int = 7) -> Model | None:
    """Trains on labelled texts; None if either label is missing or has no words.

    ``clean_weight`` is how many clean rows each sampled one stands for, over
    the same for toxic ones.
    """
    all_texts, all_toxic = texts, np.asarray(toxic, dtype=int)
    texts, y = _distinct(texts, toxic)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    groups = [words_of(texts[i : i + _GROUP]) for i in range(0, len(texts), _GROUP)]
    clean, bad = _frequencies(groups, y)
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())
    rare, guess = _first_guess(clean, bad, n0, n1)
    del clean, bad
    tables, bias = (guess[: A**3], guess[A**3 :]), None
    del guess
    random = [(g, int(w.at[i]) + int(rng.integers(0, max(1, int(w.at[i + 1] - w.at[i]) - SENTENCE + 1)))) for g, w in enumerate(groups) for i in range(len(w.at) - 1)]
    random = [x for x, label in zip(random, y, strict=True) if label == 0]
    model = None
    for _ in range(ROUNDS):
        worst = _worst(groups, y, tables)
        least = np.quantile([w[0][2] for w, label in zip(worst, y, strict=True) if label == 0], 0.97) if bias is None else -bias - 0.3
        positive = [x[:2] for w, label in zip(worst, y, strict=True) if label for j, x in enumerate(w) if not j or x[2] > least]
        negative = [x[:2] for w, label in zip(worst, y, strict=True) if not label for x in w] + random
        del tables
        common.give_back()
        model = _trained(groups, positive, negative, rare, landmarks, rng)
        tables, bias = model.tables(), model.bias
    feats = [model.text_features(words_of(all_texts[i : i + _GROUP]), tables) for i in range(0, len(all_texts), _GROUP)]
    w = _logistic(np.vstack(feats), all_toxic, np.where(all_toxic == 1, 1.0, clean_weight))
    model.text = tuple(map(float, w))
    return model


def _trained(groups: list[Words], positive: list[tuple[int, int]], negative: list[tuple[int, int]], rare: np.ndarray, landmarks: int, rng: np.random.Generator) -> Model:
    """An SVM on the Nyström features of some sentences (group, first word), folded into one weight a subsequence."""

    def of(row: tuple[int, int]) -> np.ndarray:
        return _sentence(groups[row[0]], row[1])

    marks = [of(part[i]) for part in (positive, negative) for i in rng.permutation(len(part))[: landmarks // 2]]
    made = [features(codes, rare) for codes in marks]
    norms = np.array([float(np.sqrt((v * v).sum())) or 1.0 for _, v in made])
    # All landmarks' features in one run, by number: a sentence's kernels are sums over the places it shares with them.
    number, value = np.concatenate([u for u, _ in made]), np.concatenate([v / n for (_, v), n in zip(made, norms, strict=True)])
    owner = np.repeat(np.arange(len(made)), [len(u) for u, _ in made])
    by = np.argsort(number, kind="stable")
    number, value, owner = number[by], value[by], owner[by]

    def kernels(u: np.ndarray, v: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(number, u, side="left"), np.searchsorted(number, u, side="right")
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return np.bincount(owner[at], value[at] * np.repeat(v, size), minlength=len(made))

    gram = np.stack([kernels(u, v) / n for (u, v), n in zip(made, norms, strict=True)])
    val, vec = np.linalg.eigh((gram + gram.T) / 2)
    half = vec @ np.diag(np.where(val > 1e-4, 1 / np.sqrt(np.maximum(val, 1e-4)), 0)) @ vec.T
    x = np.ones((len(positive) + len(negative), len(marks) + 1))
    for i, row in enumerate(positive + negative):
        x[i, :-1] = kernels(*features(of(row), rare))
    x[:, :-1] = x[:, :-1] @ half
    label = np.concatenate((np.ones(len(positive)), -np.ones(len(negative))))
    w = _svm(x, label, np.where(label > 0, 10.0 * len(negative) / max(1, len(positive)), 20.0))
    alpha = half @ w[:-1]
    first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    weight = np.add.reduceat(value * alpha[owner], first) * rare[number[first]]
    return Model(number[first], weight.astype(np.float32), float(w[-1]), (0.0, 1.0, 0.0), [(c, float(a) / n) for c, a, n in zip(marks, alpha, norms, strict=True)], rare)


def _score(batches: Iterator[pa.RecordBatch], model: Model | None) -> Iterator[pa.RecordBatch]:
    tables = model.tables() if model else None
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        for lo, hi in common.text_slices(texts):
            score = model.score_texts([t or "" for t in texts.slice(lo, hi - lo).to_pylist()], tables) if model else np.zeros(hi - lo)
            yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo).cast(pa.int64()), pa.array(score, pa.float64())], names=["doc_id", "score"])


def sample(docs: DataFrame, labels: DataFrame, sample_toxic: int, sample_clean: int, sample_bytes: int) -> tuple[DataFrame | None, float]:
    """Labelled documents to train on, ``picked, y, text``, and how many clean ones each clean one stands for over the same for toxic ones.

    Of both kinds the rows of least hash are taken, one after the other in equal
    shares of their numbers, as far as the bytes go.
    """
    one = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("y"))
    one = one.filter(~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    sizes = {r["y"]: r["count"] for r in one.groupBy("y").count().collect()}
    parts = [one.filter(F.col("y") == y).orderBy("h", "doc_id").limit(n) for y, n in ((1, sample_toxic), (0, sample_clean))]
    picked = parts[0].union(parts[1]).select(F.col("doc_id").alias("picked"), "y", "h")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    found = docs.select("doc_id", size.alias("bytes")).join(F.broadcast(picked), F.col("doc_id") == F.col("picked")).groupBy("picked", "y", "h").agg(F.min("bytes").alias("bytes")).collect()
    of = {y: sorted((r for r in found if r["y"] == y), key=lambda r: (r["h"], r["picked"])) for y in (0, 1)}
    order = sorted((((i + 1) / len(of[y]), -y), r) for y in of for i, r in enumerate(of[y]))
    kept, left = [], sample_bytes
    for _, r in order:
        if r["bytes"] <= left:
            left -= r["bytes"]
            kept.append((r["picked"], r["y"]))
    n = {y: sum(k[1] == y for k in kept) for y in (0, 1)}
    if not n[0] or not n[1]:
        return None, 1.0
    # From Arrow, for a list of rows would start Python workers of another kind that live on beside the others.
    wanted = F.broadcast(docs.sparkSession.createDataFrame(pa.table({"picked": pa.array([k for k, _ in kept], pa.int64()), "y": pa.array([y for _, y in kept], pa.int32())})))
    shortest = F.min(F.struct(size.alias("bytes"), F.coalesce("text", F.lit("")).alias("text")))
    rows = docs.select("doc_id", "text").join(wanted, F.col("doc_id") == F.col("picked")).groupBy("picked", "y").agg(shortest.alias("one"))
    return rows.select("picked", "y", "one.text"), (sizes[0] / n[0]) / (sizes[1] / n[1])


def _fitted(batches: Iterator[pa.RecordBatch], weight: float) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["picked"], r["y"], r["text"]) for batch in batches for r in batch.to_pylist())
    model = fit([t for *_, t in rows], [y for _, y, _ in rows], weight)
    if model:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])


def train(docs: DataFrame, labels: DataFrame, sample_toxic: int = 1200, sample_clean: int = 2400, sample_bytes: int = 24 << 20) -> Model | None:
    """Fits on labelled documents outside the held-out quarter, as many rows and bytes of text as the bounds allow, in one task.

    A document labelled twice counts as toxic if any label says so; rows with a
    null id or label are left out.  Of documents that share an id the shortest
    is taken.  Only the model comes to the driver: some 10^5 weights.
    """
    rows, weight = sample(docs, labels, sample_toxic, sample_clean, sample_bytes)
    if rows is None:
        return None
    found = rows.coalesce(1).mapInArrow(common.lean(lambda it: _fitted(it, weight)), "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def held_out(doc_id) -> F.Column:
    """The quarter of ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Only ``doc_id`` and ``text`` of ``docs`` are read; the id chooses no score.
    Null and empty texts get the score of a text without words.  Without
    labels of texts of both kinds all scores are 0.  Repeated rows give repeated
    results, an empty table an empty one; other columns are ignored.
    """
    common.short_batches(docs.sparkSession)
    model = train(docs, labels)
    scored = docs.select("doc_id", "text").mapInArrow(common.lean(lambda it: _score(it, model)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns, whatever their names.

    A null text is judged as an empty one, a null id changes nothing, repeated
    rows share their fate, and an empty table stays so.  Without labels of
    texts of both kinds all stay.
    """
    common.short_batches(docs.sparkSession)
    model = train(docs, labels)
    names, kinds = docs.columns, docs.schema

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index("text")
        tables = model.tables()
        for batch in batches:
            texts = batch.column(at)
            for lo, hi in common.text_slices(texts):
                score = model.score_texts([t or "" for t in texts.slice(lo, hi - lo).to_pylist()], tables)
                yield batch.slice(lo, hi - lo).filter(pa.array(score < threshold))

    return docs.mapInArrow(common.lean(pick), kinds) if model else docs
