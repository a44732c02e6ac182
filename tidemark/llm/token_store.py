"""Token files of patched frame-of-reference blocks.

Texts are encoded with a public byte-level BPE through the tokenizers library.
The split into pieces that such tokenizers begin with is done here for many
texts at once; each distinct piece is encoded by the library once and kept.

A file holds the ids of its documents one after the other:

    "PFR1" | blocks | documents | block starts | footer

Each block of ``BLOCK`` ids has its least id, a width, and a list of
exceptions.  The width is the one that fits ``FITS`` of the block's ids after
the least is subtracted; those that don't fit keep their low bits in place and
their high bits in the exception list.  ``block starts`` lets a reader begin at
any block.  Files are written in ascending order of document ids, each by one
task and under a name that only the attempt that ends well hands on, so a lost
executor costs no more than its own files.
"""

from __future__ import annotations

import json
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import FileSelector, FileSystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

BLOCK, FITS, END_ID = 256, 0.95, 2
#: Text bytes encoded at once, and pieces held in a dictionary before they are sorted in: workers stay small.
ENCODE_BYTES, RECENT = 1 << 18, 1 << 15
#: Ids that a task reads back: files are small where partitions are many.
READ_IDS = 1 << 24
MAGIC = b"PFR1\0\0\0\0"
_FOOT = struct.Struct("<QQQQQ8s")  # ids, documents, place of documents, place of block starts, blocks
_HEAD = 8  # bytes of a block's head: least id (4), width (1), none (1), exceptions (2); blocks are padded to multiples of 8

# ---------------------------------------------------------------- encoding

_LETTER, _NUMBER, _OTHER, _SPACE, _ODD = 0, 1, 2, 3, 4
_WHITE = {*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


def _classes() -> np.ndarray:
    """Class of each code point below 65536; unassigned ones are odd, and texts with them go to the library whole."""
    kinds = {"L": _LETTER, "N": _NUMBER}
    out = np.full(1 << 16, _OTHER, dtype=np.uint8)
    for cp in range(1 << 16):
        cat = unicodedata.category(chr(cp))
        out[cp] = _SPACE if cp in _WHITE else _ODD if cat in ("Cn", "Cs") or 0x1C <= cp <= 0x1F else kinds.get(cat[0], _OTHER)
    return out


_CLASS: np.ndarray | None = None
_SIGN = common.mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))
_SHORT = np.zeros(128, dtype=bool)
_SHORT[[ord(c) for c in "stmd"]] = True


def piece_starts(cps: np.ndarray, kind: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Where the pieces of byte-level BPE begin. ``doc`` marks places at which a text begins.

    Pieces are runs of letters, of numbers or of other signs, each with one
    blank before it, the common English clitics, and runs of white space
    without the last sign if something follows.
    """
    n = len(cps)
    space = kind == _SPACE
    start = doc[:n].copy()
    after = np.zeros(n, dtype=bool)
    after[1:] = space[:-1]
    blank = np.zeros(n, dtype=bool)
    blank[1:] = cps[:-1] == 32
    changed = np.ones(n, dtype=bool)
    changed[1:] = kind[1:] != kind[:-1]
    start |= ~space & changed & ~blank
    start |= space & changed
    ends = np.zeros(n, dtype=bool)
    ends[:-1] = ~space[1:] & ~doc[1:n]
    start |= space & after & ends
    quote = np.flatnonzero((cps == 39) & start)
    if len(quote):
        pad = np.concatenate((np.minimum(cps, 127), np.zeros(3, cps.dtype)))
        edge = np.concatenate((doc[: n + 1], np.ones(3, dtype=bool)))
        a, b = pad[quote + 1], pad[quote + 2]
        exact = np.concatenate((cps, np.zeros(3, cps.dtype)))
        inside = ~edge[quote + 1] & (exact[quote + 1] < 128)
        two = inside & _SHORT[a]
        three = inside & ~two & ~edge[quote + 2] & (exact[quote + 2] < 128) & (((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108))
        for at, size in ((quote[two], 2), (quote[three], 3)):
            start[at + 1] = False
            start[at[at + size < n] + size] = True
    return start


class Encoder:
    """Encodes texts; pieces met before come from a table, which starts anew when it is full."""

    def __init__(self, path: str, most: int = 1_000_000, slot_bits: int = 20):
        from tokenizers import Tokenizer

        global _CLASS
        if _CLASS is None:
            _CLASS = _classes()
        self.tok = Tokenizer.from_file(path)
        self.model = self.tok.model
        self.plain = not _splits_as_here(json.loads(self.tok.to_str()))
        self.specials = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.most, self.slot_bits = most, slot_bits
        self._forget()

    def _forget(self) -> None:
        self.pieces = 0
        self.keys, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.recent: dict[int, int] = {}
        self.pool = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0
        self.place = np.zeros(1 << 14, dtype=np.uint32)
        self.count = np.zeros(1 << 14, dtype=np.int32)
        self.slot_hash = np.zeros(1 << self.slot_bits, dtype=np.uint64)
        self.slot_index = np.zeros(1 << self.slot_bits, dtype=np.int32)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of pieces by their hashes, -1 for new ones: from the sorted table, else from those learnt since."""
        found = np.full(len(hashes), -1, dtype=np.int32)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            found = np.where(self.keys[at] == hashes, self.numbers[at], np.int32(-1))
        rest = np.flatnonzero(found < 0)
        found[rest] = [self.recent.get(k, -1) for k in hashes[rest].tolist()]
        return found

    def _sort_in(self) -> None:
        """Moves the pieces learnt since to the sorted table, which takes a tenth of a dictionary's memory."""
        keys, numbers = np.fromiter(self.recent.keys(), np.uint64, len(self.recent)), np.fromiter(self.recent.values(), np.int32, len(self.recent))
        by = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[by])
        self.keys, self.numbers = np.insert(self.keys, at, keys[by]), np.insert(self.numbers, at, numbers[by])
        self.recent = {}

    def _index(self, h: np.ndarray, starts: np.ndarray, stops: np.ndarray, flat: str) -> np.ndarray:
        """The number of each piece: from slots by hash, else from the table, else the piece is learnt."""
        slot = (h >> np.uint64(64 - self.slot_bits)).astype(np.int64)
        which = self.slot_index[slot]
        missed = np.flatnonzero(self.slot_hash[slot] != h)
        if len(missed):
            unique, first, inverse = np.unique(h[missed], return_index=True, return_inverse=True)
            numbers = self._known(unique)
            new = np.flatnonzero(numbers < 0)
            if self.pieces + len(new) > self.most and self.pieces:
                self._forget()
                return self._index(h, starts, stops, flat)
            if len(new):
                at = missed[first[new]]
                numbers[new] = self._learn(unique[new].tolist(), [flat[x:y] for x, y in zip(starts[at].tolist(), stops[at].tolist(), strict=True)])
            which[missed] = numbers[inverse]
            free = (unique >> np.uint64(64 - self.slot_bits)).astype(np.int64)
            self.slot_hash[free], self.slot_index[free] = unique, numbers
            lost = np.flatnonzero(self.slot_hash[free] != unique)
            self.slot_index[free[lost]] = self._known(self.slot_hash[free[lost]])
        return which

    def _learn(self, hashes: list[int], pieces: list[str]) -> np.ndarray:
        tokenize, letters = self.model.tokenize, self.letters
        ids: list[int] = []
        counts = []
        for p in pieces:
            if p.isascii() and p[1:].isalnum() and (p[0] == " " or p[0].isalnum()):
                found = tokenize("\u0120" + p[1:] if p[0] == " " else p)
            else:
                found = tokenize(p.encode().decode("latin-1").translate(letters))
            ids += [t.id for t in found]
            counts.append(len(found))
        base, m = self.pieces, len(pieces)
        while len(self.place) < base + m:
            self.place, self.count = np.concatenate((self.place, np.zeros_like(self.place))), np.concatenate((self.count, np.zeros_like(self.count)))
        while len(self.pool) < self.used + len(ids):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        sizes = np.array(counts, dtype=np.int64)
        self.pool[self.used : self.used + len(ids)] = ids
        self.place[base : base + m] = self.used + np.cumsum(sizes) - sizes
        self.count[base : base + m] = sizes
        self.used += len(ids)
        self.pieces += m
        self.recent.update(zip(hashes, range(base, base + m), strict=True))
        if len(self.recent) > RECENT:
            self._sort_in()
        return np.arange(base, base + m, dtype=np.int32)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, ids of each text); no end ids. A tokenizer that splits otherwise is left to the library."""
        if self.plain:
            parts = [np.array(e.ids, dtype=np.uint32) for e in self.tok.encode_batch(texts, add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(p) for p in parts], dtype=np.int64)
        odd = [i for i, t in enumerate(texts) if any(s in t for s in self.specials)]
        plain = list(texts)
        for i in odd:
            plain[i] = ""
        flat = "".join(plain)
        cps = np.frombuffer(flat.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum(np.fromiter(map(len, plain), dtype=np.int64, count=len(plain)))
        kind = _CLASS[np.minimum(cps, 0xFFFF)]
        strange = np.flatnonzero((kind == _ODD) | (cps > 0xFFFE))
        if len(strange):
            worse = np.unique(np.searchsorted(ends, strange, side="right")).tolist()
            return self._patched(texts, sorted({*odd, *worse}))
        if odd:
            return self._patched(texts, odd)
        if not len(cps):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        doc = np.zeros(len(cps) + 1, dtype=bool)
        doc[0] = True
        doc[ends] = True
        starts = np.flatnonzero(piece_starts(cps, kind, doc))
        stops = np.append(starts[1:], len(cps))
        sums = np.zeros(len(cps) + 1, dtype=np.uint64)
        np.cumsum(_SIGN[cps] * common._power("up", len(cps)), out=sums[1:])
        h = common.mix((sums[stops] - sums[starts]) * common._power("down", len(cps))[starts] + (stops - starts).astype(np.uint64))
        which = self._index(h, starts, stops, flat)
        sizes = self.count[which].astype(np.int64)
        upto = np.cumsum(sizes)
        ids = self.pool[np.repeat(self.place[which].astype(np.int64) - (upto - sizes), sizes) + np.arange(upto[-1])]
        done = np.concatenate(([0], upto))[np.searchsorted(starts, ends)]
        return ids, np.diff(done, prepend=0)

    def long(self, text: str, size: int = ENCODE_BYTES) -> Iterator[np.ndarray]:
        """Ids of a text of any length in turn, in parts of about ``size`` signs that end before a blank between two other signs, where a piece begins.

        A text with special tokens, one of a tokenizer that splits otherwise, and a part without such a blank are encoded whole.
        """
        if self.plain or any(s in text for s in self.specials):
            yield self([text])[0]
            return
        lo, far = 0, size
        while lo < len(text):
            part = text[lo : lo + far]
            if lo + far < len(text):
                cps = np.frombuffer(part.encode("utf-32-le"), dtype=np.uint32)
                solid = _CLASS[np.minimum(cps, 0xFFFF)] < _SPACE
                cuts = np.flatnonzero((cps[1:-1] == 0x20) & solid[:-2] & solid[2:])
                if not len(cuts):
                    far *= 2
                    continue
                part = part[: int(cuts[-1]) + 1]
            yield self([part])[0]
            lo, far = lo + len(part), size

    def _patched(self, texts: list[str], odd: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Some texts by the library alone, the others as usual."""
        alone = set(odd)
        rest = [i for i in range(len(texts)) if i not in alone]
        ids, sizes = self([texts[i] for i in rest]) if rest else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i, part in zip(rest, np.split(ids, np.cumsum(sizes)[:-1]) if rest else [], strict=True):
            parts[i] = part
        for i in odd:
            parts[i] = np.array(self.tok.encode(texts[i], add_special_tokens=False).ids, dtype=np.uint32)
        return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)


def _splits_as_here(spec: dict) -> bool:
    """Whether a tokenizer's pieces are those of ``piece_starts``: byte-level BPE by its usual pattern, texts as they are, no chance."""
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    usual = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "unk_token"))
    added = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") and spec.get("normalizer") for t in spec.get("added_tokens", []))
    return bool(usual and plain and added and model.get("type") == "BPE" and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding"))


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE writes each byte as a letter: printable Latin-1 bytes as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


# ---------------------------------------------------------------- blocks


def _runs(at: np.ndarray, size: int) -> np.ndarray:
    return at[:, None] + np.arange(size)


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of ids, whose number is a multiple of BLOCK; and where each block starts."""
    table = ids.astype(np.uint32).reshape(-1, BLOCK)
    least = table.min(axis=1)
    rest = table - least[:, None]
    nth = int(FITS * (BLOCK - 1))
    fit = np.partition(rest, nth, axis=1)[:, nth]
    widths = np.zeros(len(table), dtype=np.int64)
    for bit in range(32):
        widths[fit >> np.uint32(bit) > 0] = bit + 1
    high = rest >> np.minimum(widths, 31).astype(np.uint32)[:, None]
    high[widths == 32] = 0
    flat = np.flatnonzero(high)
    row, where = flat // BLOCK, flat % BLOCK
    many = np.bincount(row, minlength=len(table))
    body = BLOCK // 8 * widths
    sizes = _HEAD + body + (6 * many + 7) // 8 * 8
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()) // 8, dtype="<u8")
    out[starts // 8] = least.astype(np.uint64) | widths.astype(np.uint64) << np.uint64(32) | many.astype(np.uint64) << np.uint64(48)
    for w in np.unique(widths).tolist():
        if not w:
            continue
        rows = np.flatnonzero(widths == w)
        lanes = np.ascontiguousarray(rest[rows].T).astype(np.uint64) & np.uint64((1 << w) - 1)
        words = np.zeros((BLOCK * w // 64, len(rows)), dtype=np.uint64)
        for j in range(BLOCK):
            at, shift = divmod(j * w, 64)
            words[at] |= lanes[j] << np.uint64(shift)
            if shift + w > 64:
                words[at + 1] |= lanes[j] >> np.uint64(64 - shift)
        out[_runs((starts[rows] + _HEAD) // 8, len(words))] = words.T
    if len(row):
        nth_of = np.arange(len(row)) - (np.cumsum(many) - many)[row]
        at = (starts + _HEAD + body)[row]
        halves = out.view("<u2")
        halves[at // 2 + nth_of] = where
        top = high.reshape(-1)[flat]
        place = at // 2 + many[row] + 2 * nth_of
        halves[place], halves[place + 1] = top & np.uint32(0xFFFF), top >> np.uint32(16)
    return out.tobytes(), starts


def unpack_blocks(raw: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of the blocks that begin at ``starts`` in ``raw``."""
    whole = np.frombuffer(raw, dtype="<u8")
    head = whole[starts // 8]
    least = (head & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    widths = (head >> np.uint64(32) & np.uint64(0xFF)).astype(np.int64)
    many = (head >> np.uint64(48)).astype(np.int64)
    out = np.zeros((len(starts), BLOCK), dtype=np.uint32)
    for w in np.unique(widths).tolist():
        if not w:
            continue
        rows = np.flatnonzero(widths == w)
        words = np.ascontiguousarray(whole[_runs((starts[rows] + _HEAD) // 8, BLOCK * w // 64)].T)
        lanes = np.zeros((BLOCK, len(rows)), dtype=np.uint32)
        for j in range(BLOCK):
            at, shift = divmod(j * w, 64)
            v = words[at] >> np.uint64(shift)
            if shift + w > 64:
                v |= words[at + 1] << np.uint64(64 - shift)
            lanes[j] = v & np.uint64((1 << w) - 1)
        out[rows] = lanes.T
    if many.any():
        row = np.repeat(np.arange(len(starts)), many)
        nth_of = np.arange(len(row)) - (np.cumsum(many) - many)[row]
        at = (starts + _HEAD + BLOCK // 8 * widths)[row] // 2
        halves = whole.view("<u2")
        place = at + many[row] + 2 * nth_of
        high = halves[place].astype(np.uint64) | halves[place + 1].astype(np.uint64) << np.uint64(16)
        out[row, halves[at + nth_of]] |= (high << widths[row].astype(np.uint64)).astype(np.uint32)
    return (out + least[:, None]).reshape(-1)


class Writer:
    """Writes one file as ids come; holds less than a slice of them."""

    def __init__(self, stream):
        self.stream, self.at, self.left = stream, len(MAGIC), np.zeros(0, np.uint32)
        self.starts: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.ids = 0
        stream.write(MAGIC)

    def _blocks(self, ids: np.ndarray) -> None:
        packed, starts = pack_blocks(ids)
        self.starts.append(starts + self.at)
        self.at += len(packed)
        self.stream.write(packed)

    def add(self, keys: np.ndarray, known: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with the rest of their ids; the ids of a long one may have come by ``more`` before."""
        self.docs.append(np.column_stack((keys, known, sizes)).astype("<i8"))
        self.more(ids)

    def more(self, ids: np.ndarray) -> None:
        self.ids += len(ids)
        ids = np.concatenate((self.left, ids))
        whole = len(ids) // BLOCK * BLOCK
        if whole:
            self._blocks(ids[:whole])
        self.left = ids[whole:]

    def close(self) -> None:
        if len(self.left):
            self._blocks(np.concatenate((self.left, np.full(BLOCK - len(self.left), self.left[0], np.uint32))))
        docs = np.concatenate(self.docs) if self.docs else np.zeros((0, 3), "<i8")
        docs_at = self.at
        self.stream.write(docs.tobytes())
        starts = np.concatenate(self.starts).astype("<u8") if self.starts else np.zeros(0, "<u8")
        self.stream.write(starts.tobytes())
        self.stream.write(_FOOT.pack(self.ids, len(docs), docs_at, docs_at + docs.nbytes, len(starts), MAGIC))
        self.stream.close()


def read_file(source, step: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(document rows [id, has id, ids], start in the file of each, their ids) for runs of documents of a file."""
    source.seek(source.size() - _FOOT.size)
    ids, docs, docs_at, starts_at, blocks, magic = _FOOT.unpack(source.read(_FOOT.size))
    if magic != MAGIC:
        raise ValueError("not a token file")
    source.seek(docs_at)
    rows = np.frombuffer(source.read(docs * 24), "<i8").reshape(-1, 3)
    starts = np.frombuffer(source.read(blocks * 8), "<u8").astype(np.int64)
    bounds = np.append(starts, docs_at)
    begin = np.cumsum(rows[:, 2]) - rows[:, 2]
    d = 0
    while d < docs:
        last = max(d + 1, int(np.searchsorted(begin + rows[:, 2], begin[d] + step * BLOCK, side="right")))
        lo, hi = int(begin[d]), int(begin[last - 1] + rows[last - 1, 2])
        first, stop = lo // BLOCK, -(-hi // BLOCK)
        source.seek(int(bounds[first]))
        part = np.empty((stop - first) * BLOCK, dtype=np.uint32)
        for a in range(first, stop, step):
            b = min(a + step, stop)
            part[(a - first) * BLOCK : (b - first) * BLOCK] = unpack_blocks(source.read(int(bounds[b] - bounds[a])), starts[a:b] - bounds[a])
        yield rows[d:last], begin[d:last], part[lo - first * BLOCK : hi - first * BLOCK]
        d = last


# ---------------------------------------------------------------- tables


def _folder(root: str):
    return FileSystem.from_uri(root if "://" in root or not root.startswith("file:") else root.replace("file:", "file://", 1))


_encoders: dict[str, Encoder] = {}
_MANIFEST = "part long, name string, docs long, ids long"


def _write(batches: Iterator[pa.RecordBatch], root: str, path: str) -> Iterator[pa.RecordBatch]:
    batches = iter(batches)
    batch = next((b for b in batches if b.num_rows), None)
    if batch is None:
        return
    fs, folder = _folder(root)
    task = TaskContext.get()
    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}.pfr"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    encode = _encoders[path]
    out, docs = Writer(fs.open_output_stream(f"{folder}/{name}")), 0
    while batch is not None:
        keys, texts = batch.column(0), batch.column(1)
        for lo, hi in common.text_slices(texts, ENCODE_BYTES):
            given = [t or "" for t in texts.slice(lo, hi - lo).to_pylist()]
            if len(given) == 1 and len(given[0]) > ENCODE_BYTES:
                before = out.ids
                for ids in encode.long(given[0]):
                    out.more(ids)
                sizes, with_end = np.array([out.ids - before], dtype=np.int64), np.array([END_ID], dtype=np.uint32)
            else:
                ids, sizes = encode(given)
                with_end = np.insert(ids, np.cumsum(sizes), END_ID)
            part = keys.slice(lo, hi - lo)
            out.add(np.asarray(pa.compute.fill_null(part, 0), dtype=np.int64), np.asarray(part.is_valid(), dtype=np.int64), sizes + 1, with_end)
            docs += hi - lo
        batch = next(batches, None)
    out.close()
    yield pa.RecordBatch.from_arrays([pa.array([task.partitionId()], pa.int64()), pa.array([name]), pa.array([docs], pa.int64()), pa.array([out.ids], pa.int64())], names=["part", "name", "docs", "ids"])


def _read(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    fs, folder = _folder(root)
    for batch in batches:
        for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            with fs.open_input_file(f"{folder}/{name}") as source:
                for rows, begin, ids in read_file(source):
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    at = (begin - begin[0]) * 4
                    crcs = [zlib.crc32(raw[a : a + 4 * n]) for a, n in zip(at.tolist(), rows[:, 2].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[:, 0], pa.int64(), mask=rows[:, 1] == 0), pa.array(begin + base, pa.int64()), pa.array(rows[:, 2], pa.int64()), pa.array(crcs, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )


def write_tokens(docs: DataFrame, root: str, tokenizer: str) -> DataFrame:
    """Writes the token files of ``docs`` below ``root``; returns their manifest ``part, name, docs, ids``.

    Documents are in ascending order of doc_id over the files (null first, rows
    of equal id by a hash of their text).  A null text is an empty one.  Files of
    attempts that failed are deleted once the manifest is there.  It has one row a
    file and stays with the driver, so no task starts a table for a row of its own.
    """
    spark = docs.sparkSession
    common.short_batches(spark)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    with common.shuffles_go(spark):
        rows = ordered.mapInArrow(common.lean(lambda it: _write(it, root, tokenizer)), _MANIFEST).collect()
    fs, folder = _folder(root)
    named = {r["name"] for r in rows}
    for f in fs.get_file_info(FileSelector(folder)):
        if f.base_name not in named:  # left by an attempt that didn't end well
            fs.delete_file(f.path)
    columns = [pa.array([r[c] for r in rows], pa.string() if c == "name" else pa.int64()) for c in ("part", "name", "docs", "ids")]
    return spark.createDataFrame(pa.table(columns, names=["part", "name", "docs", "ids"]))


def read_tokens(manifest: DataFrame, root: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files; one row a file is ordered in one task, documents are not.

    A task reads about READ_IDS ids, whole files, or fewer where cores would else be idle.
    """
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("name", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    there, ids = manifest.agg(F.count("*"), F.coalesce(F.sum("ids"), F.lit(0))).first()
    tasks = min(there, max(manifest.sparkSession.sparkContext.defaultParallelism, -(-ids // READ_IDS)))
    return files.repartition(max(1, tasks)).mapInArrow(common.lean(lambda it: _read(it, root)), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_store(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Encodes, writes and reads back: ``doc_id, start, n_tokens, ids_crc32`` for every document.

    Each document's ids end with END_ID, so an empty or null text has one id.
    ``tokenizer`` is the path of a byte-level BPE in the tokenizers library's
    format, the same on every machine.  Repeated rows are stored again, a null id
    comes first, an empty table gives an empty one, other columns are ignored.
    """
    root = common.scratch_path(docs.sparkSession, "tokens")
    fs, folder = _folder(root)
    fs.create_dir(folder)
    return read_tokens(write_tokens(docs, root, tokenizer), root)
