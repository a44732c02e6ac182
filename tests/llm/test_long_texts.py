"""Texts of any length: worked on in slices, with the same values as whole ones, in bounded memory."""

import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, decontaminate, ngram_join, token_store
from tidemark.llm.queries import tokenizer_path


@pytest.mark.parametrize("limit", [1, 2, 3, 7, 16, 64, 1000])
@pytest.mark.parametrize("lower", [True, False])
def test_sliced_words_are_those_of_whole_texts(limit, lower):
    rng = random.Random(limit)
    for _ in range(60):
        texts = ["".join(rng.choices(rng.choice(["ab ", "aB\t\né", "abcdefg", " ", "Aé漢 "]), k=rng.randrange(60))) for _ in range(rng.randrange(1, 6))]
        raw, offsets = common.string_bytes(pa.array(texts, pa.string()))
        starts, ends, at = common.word_spans(raw, offsets)
        h, where = common.hashed_words(raw, offsets, lower=lower, limit=limit)
        assert where.tolist() == at.tolist() == [0, *np.cumsum([len([w for w in t.replace("\t", " ").replace("\n", " ").split(" ") if w]) for t in texts]).tolist()]
        assert h.tolist() == common.word_hashes(raw, starts, ends, lower).tolist()


def test_runs_and_sketches_in_slices(monkeypatch):
    rng = np.random.default_rng(5)
    whole = []
    for size in (1 << 17, 64):
        monkeypatch.setattr(common, "SLICE_WORDS", size)
        got = []
        for n in (1, 2, 63, 64, 65, 1000, 5000):
            words = common.mix(np.arange(n, dtype=np.uint64) % np.uint64(max(1, n - n // 10)))
            h = ngram_join.shingle_set(words, 4)
            assert h.tolist() == sorted(set(common.shingle_hashes(words, 4).tolist()))
            bands = ngram_join.size_bands(1 << 20, 85)
            band = int(np.searchsorted(bands, len(h), side="right")) - 1
            keys, slack = ngram_join._band_keys(h, band, bands[band + 1], 85)
            marked = decontaminate._marked(decontaminate._bits_of(h[: n // 2 + 1]), common.mix(words))
            got.append((h.tolist(), ngram_join._signature(h), ngram_join._bits(h), keys.tolist(), slack, marked.tolist(), [(s, x.tolist()) for s, x in decontaminate.runs(words, 3)]))
        whole.append(got)
    assert whole[0] == whole[1]
    h = np.unique(rng.integers(0, 1 << 63, 3000, dtype=np.uint64))
    bits = np.unpackbits(np.frombuffer(ngram_join._bits(h), np.uint8))
    odd = np.bincount((h % np.uint64(len(bits))).astype(np.int64), minlength=len(bits)) % 2
    assert bits.tolist() == odd.tolist()


@pytest.mark.parametrize("size", [2, 5, 40, 1000])
def test_long_texts_encode_as_by_the_library(size):
    rng, e = random.Random(size), token_store.Encoder(tokenizer_path())
    for alphabet in ("ab  c'sd", "It's 42  x\n\t.,!", "漢字 é", "x͸ y", "  a b 1", "a", " ", "a😀 b"):
        for n in (0, 1, 3, 200, 700):
            text = "".join(rng.choices(alphabet, k=n))
            assert [i for part in e.long(text, size) for i in part.tolist()] == e.tok.encode(text, add_special_tokens=False).ids
    text = "one two " * 50 + "</s> three <s>" + " four" * 50
    assert [i for part in e.long(text, size) for i in part.tolist()] == e.tok.encode(text, add_special_tokens=False).ids


def test_links_of_long_texts(spark):
    """Texts of several slices, against plain sets: the second differs in a tenth of a hundred places, the third by half."""
    rng = random.Random(9)
    words = [f"{rng.choice('Aabc')}{rng.randrange(10**6)}" for _ in range(170_000)]
    near = [w if i % 1700 else "other" for i, w in enumerate(words)]
    far = [w if i % 10 else "other" for i, w in enumerate(words)]
    texts = {1: " ".join(words), 2: "\n".join(near), 3: "\t".join(far), 4: "x" * (3 << 19), 5: "x" * (3 << 19) + " ", 6: "x" * ((3 << 19) + 1)}
    assert len(texts[1]) > common.SLICE_BYTES

    def shingles(text):
        w = text.lower().split()
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))}

    sets = {i: shingles(t) for i, t in texts.items()}
    linked = lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3), k=4, percent=85).collect()}
    assert linked(1, 2) and not linked(1, 3) and not linked(2, 3)
    assert got == {i: (len(s), min(j for j in sets if linked(i, j))) for i, s in sets.items()}


_WORK = """
import random, resource, sys
import numpy as np, pyarrow as pa
from tidemark.llm import decontaminate, ngram_join, token_store
from tidemark.llm.queries import tokenizer_path
rng = np.random.default_rng(1)
letters = rng.integers(97, 107, 64 << 20, dtype=np.uint8)
letters[rng.integers(0, 64 << 20, 11 << 20)] = 32
if sys.argv[1] == "op9":
    letters = np.tile(letters[: 2 << 20], 32)
text = pa.Array.from_buffers(pa.string(), 1, [None, pa.py_buffer(np.array([0, 64 << 20], np.int32)), pa.py_buffer(letters)])
one = pa.array([1])
if sys.argv[1] == "op4":
    batch = pa.RecordBatch.from_arrays([one, one, pa.array([1], pa.int32()), text], names=["doc_id", "th", "t2", "text"])
    assert next(ngram_join._sketch(iter([batch]), 4, 85)).column(3)[0].as_py() > 5_000_000
elif sys.argv[1] == "op5":
    cut = bytes(letters[30 << 20 : (30 << 20) + 600]).decode().split()[1:61]
    item, _ = decontaminate.words_of(pa.array([" ".join(cut)]))
    _, seeds, places = decontaminate.seeds_of(item, np.full(60, 1e-5))
    order, none = np.argsort(seeds), (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    items = decontaminate.Items([7], [item], {1: none, 2: none, 3: (seeds[order], np.zeros(len(order), np.int64), np.asarray(places)[order])})
    rows = [r for b in decontaminate._find(iter([pa.RecordBatch.from_arrays([one, text], names=["doc_id", "text"])]), items, 0.4) for r in b.to_pylist()]
    assert [(r["item_id"], r["score"]) for r in rows] == [(7, 1.0)]
else:
    path, encode = sys.argv[2], token_store.Encoder(tokenizer_path())
    with open(path, "wb") as f:
        out = token_store.Writer(f)
        for ids in encode.long(text[0].as_py()):
            out.more(ids)
        out.add(one.to_numpy(), one.to_numpy(), np.array([out.ids]), np.zeros(0, np.uint32))
        written = out.ids
        out.close()
    del encode
    with pa.OSFile(path) as f:
        assert [len(ids) for *_, ids in token_store.read_file(f)] == [written] and written > 10_000_000
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""


@pytest.mark.parametrize("which", ["op4", "op5", "op9"])
def test_a_text_of_64_mb_takes_less_than_600(which, tmp_path):
    done = subprocess.run([sys.executable, "-c", _WORK, which, str(tmp_path / "tokens")], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout) < 600, done.stdout
