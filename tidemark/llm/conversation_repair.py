"""Conversation structure repair by error-correcting Earley parsing.

The grammar is that of role initials, ``(s?(ua)+)?``, read from the last row to
the first, so that what an item has matched is the end of the conversation and
audits grow at their front:

    R -> E | S      E -> (nothing) | U      U -> A u      A -> E a      S -> U s

Error productions let a row be deleted, take another role, or stand where none
is.  The rules are left-recursive and all items begin in the first column, so a
column has few items and a parse is linear.  An item keeps the least (cost,
audit); different ways to one item differ in their newest edit, so audits are
compared by that letter alone and share their tails.

What a column hands to the next are four items: those that wait for a role, and
the finished R.  So a piece of a conversation can be parsed by itself, once from
each of the four, and pieces are joined by least sums: rows are sorted in
ranges, whatever conversation they are of, and a conversation of any length is
parsed by many tasks.  The repaired text is hashed row by row behind it.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lean, salted, scratch_path, shuffles_go, written

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
#: What edits cost, and what a truncated row adds where it isn't deleted.
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1
#: Rows of a conversation that are parsed as one piece.
PIECE = 4096
#: Pieces of at most so many rows are remembered, so many of them: most conversations are short and alike.
SHORT, REMEMBERED = 24, 1 << 14
#: Roles that a row may take, or be put in with, by what the grammar reads.
ROLE = {"u": "user", "a": "assistant"}
#: Letters of rows: initial and fault. Upper case: truncated. ``x``: another initial. ``-``: must be deleted.
LEGAL = {"su", "ua", "au"}

_GRAMMAR: dict[str, list[tuple[str, ...]]] = {"R": [("E",), ("S",)], "E": [(), ("U",)], "U": [("A", "u")], "A": [("E", "a")], "S": [("U", "s")]}
Item = tuple[str, tuple[str, ...], int]
#: What passes from a column to the next.
WAITING: tuple[Item, ...] = (("A", ("E", "a"), 1), ("U", ("A", "u"), 1), ("S", ("U", "s"), 1), ("R", (), 0))
_DONE = WAITING[3]
#: An audit as its newest edit and the audit behind it.
Trail = tuple | None


def _column(seeds: dict[Item, tuple[int, Trail]], insert: bool = True) -> dict[Item, tuple[int, Trail]]:
    """A column's items, completed, and by rows put in: cheapest first, of equal cost by the newest edit."""
    found: dict[Item, tuple[int, Trail]] = {}
    agenda = [(cost, trail[0] if trail else "", i, item, trail) for i, (item, (cost, trail)) in enumerate(seeds.items())]
    heapq.heapify(agenda)
    tick = len(agenda)
    while agenda:
        cost, letter, _, item, trail = heapq.heappop(agenda)
        if item in found:
            continue
        found[item] = (cost, trail)
        lhs, rhs, dot = item
        if dot == len(rhs):
            # Complete: all items begin in the first column, so its parents are the rules that it is first in.
            more = [(cost, trail, (up, r, 1) if up != "R" else _DONE) for up, rules in _GRAMMAR.items() for r in rules if r[:1] == (lhs,)] if item != _DONE else []
        elif insert and rhs[dot] in ROLE:
            more = [(cost + COST[INSERT], (INSERT, trail), (lhs, rhs, dot + 1))]
        else:
            more = []
        for c, t, to in more:
            if to not in found:
                tick += 1
                heapq.heappush(agenda, (c, t[0] if t else "", tick, to, t))
    return found


def _scanned(column: dict[Item, tuple[int, Trail]], row: str) -> dict[Item, tuple[int, Trail]]:
    """The next column's first items, by the edits of one row."""
    seeds: dict[Item, tuple[int, Trail]] = {}
    cut = TRUNCATED if row.isupper() else 0
    for item in WAITING:
        if item not in column:
            continue
        cost, trail = column[item]
        lhs, rhs, dot = item
        ways = [(cost + COST[DELETE], DELETE, item)]
        if row != "-" and item != _DONE:
            wanted = rhs[dot]
            if row.lower() == wanted:
                ways.append((cost + COST[KEEP] + cut, KEEP, (lhs, rhs, dot + 1)))
            if wanted in ROLE:
                ways.append((cost + COST[REROLE] + cut, REROLE, (lhs, rhs, dot + 1)))
        for c, letter, to in ways:
            if to not in seeds or (c, letter) < (seeds[to][0], seeds[to][1][0]):
                seeds[to] = (c, (letter, trail))
    return seeds


def _letters(trail: Trail) -> str:
    out = []
    while trail:
        out.append(trail[0])
        trail = trail[1]
    return "".join(out)


Ways = list[list[tuple[int, str] | None]]


def piece_ways(rows: str) -> Ways:
    """For a piece of row letters: ``[left][right]``, the least (cost, audit) from waiting item ``right`` behind it to ``left`` before it, or None."""
    out: Ways = [[None] * len(WAITING) for _ in WAITING]
    for r, seed in enumerate(WAITING):
        column: dict[Item, tuple[int, Trail]] = {seed: (0, None)}
        for row in reversed(rows):
            column = _column(_scanned(column, row))
        for k, item in enumerate(WAITING):
            if item in column:
                out[k][r] = (column[item][0], _letters(column[item][1]))
    return out


_short_ways = lru_cache(REMEMBERED)(piece_ways)


def _ways(rows: str) -> Ways:
    return _short_ways(rows) if len(rows) <= SHORT else piece_ways(rows)


def joined(pieces: list[Ways]) -> tuple[int, str]:
    """The least (cost, audit) of a conversation from its pieces in order."""
    end = _column({("E", (), 0): (0, None)})
    best = [(end[i][0], [_letters(end[i][1])]) if i in end else None for i in WAITING]
    for ways in reversed(pieces):
        new = []
        for left in range(len(WAITING)):
            # Audits of a piece to the same item differ within the piece: what is behind it needs no comparison.
            options = [(best[r][0] + w[0], w[1], r) for r, w in enumerate(ways[left]) if w and best[r]]
            if options:
                cost, audit, r = min(options)
                new.append((cost, [best[r][1], audit]))
            else:
                new.append(None)
        best = new
    cost, audit = best[WAITING.index(_DONE)]
    parts = []
    while len(audit) == 2:
        parts.append(audit[1])
        audit = audit[0]
    return cost, "".join(parts) + audit[0]


def parse(rows: str) -> tuple[int, str]:
    """The least (cost, audit) of a conversation's row letters."""
    return joined([piece_ways(rows)])


def illegal(rows: str) -> int:
    """Neighbours whose initials may not follow each other."""
    return sum(a + b not in LEGAL for a, b in zip(rows, rows[1:]))


def _crc(conv: Column, turn: Column) -> Column:
    return F.crc32(F.concat(conv, F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" "))))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv, conv_id, turn, role, text, dropped`` of ``conv_id, turn, role, text``: a known share of rows with known faults.

    By crc32 of ``conv_id:turn`` modulo 20 (null: one space): 0 drops a row, 1 empties its text, 2 takes out its ``[.!?]``, 3
    repeats it, 4 makes its role user. ``conv`` is the id as text. Dropped rows stay, marked, for their conversation's sake.
    """
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    made = rows.select(conv.alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    made = made.withColumn("_fate", F.pmod(_crc(F.col("conv"), F.col("turn")), F.lit(20)).cast("int"))
    text = F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    made = made.select("conv", "conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_fate")
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return made.withColumn("_copy", F.explode(copies)).select("conv", "conv_id", "turn", "role", "text", (F.col("_fate") == 0).alias("dropped"))


def plain(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` as they are, in the form of ``damaged``."""
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(" "))
    return rows.select(conv.alias("conv"), F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.lit(False).alias("dropped"))


#: The order of a conversation's rows: by turn, null first, then by role and the text's md5.
ORDER = ("_has", "_turn", "role", "_hash")


def _placed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_has": F.col("turn").isNotNull().cast("int"), "_turn": F.coalesce("turn", F.lit(0).cast("long")), "_hash": F.md5("text")})


def row_letters(rows: DataFrame) -> DataFrame:
    """``conv, _has, _turn, role, _hash, n, first, letter, blank, cut``: each distinct row of a conversation once, with its number, and whether its role and text are seen for the first time.

    Rows are counted before they are shuffled, and only those whose role and text come in several turns are looked up.
    """
    last = F.regexp_extract("text", rf"([^\x20\x09-\x0D])[\x20\x09-\x0D]*$", 1)
    blank = ~F.col("text").rlike(WORD)
    slim = _placed(rows.filter(~F.col("dropped"))).select("conv", *ORDER, blank.alias("blank"), (~blank & ~last.isin(".", "!", "?")).alias("cut"))
    slim = written(slim.groupBy("conv", *ORDER).agg(F.count("*").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "turns")
    least = F.min(F.struct("_has", "_turn")).alias("least")
    again = written(slim.groupBy("conv", "role", "_hash").agg(least, F.count("*").alias("_weight")).filter("_weight > 1"), "repeated-turns")
    found = salted(slim, again, ["conv", "role", "_hash"], "_weight", ["_has", "_turn"], how="left")
    first = F.col("least").isNull() | ((F.col("least._has") == F.col("_has")) & (F.col("least._turn") == F.col("_turn")))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return found.select("conv", *ORDER, "n", first.alias("first"), letter.alias("letter"), "blank", "cut")


_PIECE = "conv string, part long, piece long, ways array<struct<cost: long, audit: string>>, head string, tail string, n long, blank long, duplicate long, truncated long, illegal long, lo long, hi long, turns long, first_turn long, last_turn long"
_PIECE_ARROW = pa.schema(
    [("conv", pa.string()), ("part", pa.int64()), ("piece", pa.int64()), ("ways", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))), ("head", pa.string()), ("tail", pa.string())]
    + [(c, pa.int64()) for c in ("n", "blank", "duplicate", "truncated", "illegal", "lo", "hi", "turns", "first_turn", "last_turn")]
)


class _Piece:
    """Rows in order, up to PIECE of them, as letters and counts."""

    def __init__(self, conv: str):
        self.conv, self.letters, self.initials = conv, [], []
        self.blank = self.duplicate = self.truncated = self.turns = 0
        self.lo = self.hi = self.first_turn = self.last_turn = None

    def add(self, letter: str, initial: str, fault: str | None, turn: int | None) -> None:
        self.letters.append(letter)
        self.initials.append(initial)
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        if turn is not None:
            if turn != self.last_turn:
                self.turns += 1
            if self.lo is None:
                self.lo = self.first_turn = turn
            self.hi = self.last_turn = turn

    def values(self, part: int, number: int) -> tuple:
        flat = [None if w is None else {"cost": w[0], "audit": w[1]} for line in _ways("".join(self.letters)) for w in line]
        initials = "".join(self.initials)
        return (self.conv, part, number, flat, initials[0], initials[-1], len(initials), self.blank, self.duplicate, self.truncated, illegal(initials), self.lo, self.hi, self.turns, self.first_turn, self.last_turn)


def _emit(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _pieces(size: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        piece: _Piece | None = None
        number, out = 0, []
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for conv, has, turn, n, first, initial, blank, cut in zip(*cols):
                for i in range(n):
                    if piece is None or piece.conv != conv or len(piece.letters) >= size:
                        if piece is not None:
                            out.append(piece.values(part, number))
                            number += 1
                        piece = _Piece(conv)
                    fresh = first and i == 0
                    fault = "blank" if blank else "duplicate" if not fresh else "truncated" if cut else None
                    letter = "-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
                    piece.add(letter, initial, fault, turn if has else None)
            if len(out) >= 256:
                yield _emit(out, _PIECE_ARROW)
                out = []
        if piece is not None:
            out.append(piece.values(part, number))
        if out:
            yield _emit(out, _PIECE_ARROW)

    return lean(work)


_AUDIT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT_ARROW = pa.schema([("conv", pa.string()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string())])


def _combined(pieces: list[dict]) -> tuple:
    """One conversation from its pieces in order."""
    ways, total = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    before = None
    for p in pieces:
        flat = [w and (w["cost"], w["audit"]) for w in p["ways"]]
        ways.append([flat[i : i + len(WAITING)] for i in range(0, len(flat), len(WAITING))])
        for c in total:
            total[c] += p[c]
        if before is not None:
            total["illegal"] += before["tail"] + p["head"] not in LEGAL
            total["turns"] -= p["first_turn"] is not None and p["first_turn"] == before["last_turn"]
        before = p
    known = [p for p in pieces if p["lo"] is not None]
    gaps = known[-1]["hi"] - known[0]["lo"] + 1 - total["turns"] if known else 0
    cost, audit = joined(ways)
    return (pieces[0]["conv"], gaps, total["blank"], total["duplicate"], total["truncated"], total["illegal"], cost, audit)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                out.append(_combined(held))
                held = []
            held.append(row)
        if out:
            yield _emit(out, _AUDIT_ARROW)
    if held:
        yield _emit([_combined(held)], _AUDIT_ARROW)


def audits(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation that has rows (in the form of ``damaged``)."""
    spark = rows.sparkSession
    letters = row_letters(rows).select("conv", *ORDER, "n", "first", "letter", "blank", "cut")
    ranged = letters.repartitionByRange(F.col("conv"), *(F.col(c) for c in ORDER)).sortWithinPartitions("conv", *ORDER)
    path = scratch_path(spark, "pieces")
    with shuffles_go(spark):
        ranged.select("conv", "_has", "_turn", "n", "first", "letter", "blank", "cut").mapInArrow(_pieces(piece), _PIECE).write.parquet(path)
    pieces = spark.read.schema(_PIECE).parquet(path)
    return pieces.repartition("conv").sortWithinPartitions("conv", "part", "piece").mapInArrow(lean(_conversations), _AUDIT)


class Repaired:
    """Rows of a conversation in order, edited by its audit, as they come."""

    def __init__(self, audit: str):
        self.audit, self.at, self.put = audit, 0, 0
        # The first role is the system's if the number of rows is odd; then user and assistant take turns.
        self.system = (len(audit) - audit.count(DELETE)) % 2
        self.digest = hashlib.sha256()

    def _out(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.put else "").encode() + f"{role}:{text}".encode())
        self.put += 1

    def _role(self) -> str:
        return ROLE["ua"[(self.put - self.system) % 2]]

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            self._out(role if edit == KEEP else self._role(), text)

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == INSERT:
            self.at += 1
            self._out(self._role(), "")

    def end(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


_OUT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OUT_ARROW = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's audit comes first, then its rows: each is hashed and let go."""
    conv, conv_id, head, repaired = None, None, None, None

    def done() -> tuple:
        counts = [head[c] for c in _COUNTS] if head else [0] * len(_COUNTS)
        return (conv_id, *counts, head["audit"] if head else "", (repaired or Repaired("")).end())

    for batch in batches:
        out = []
        names = batch.schema.names
        convs, kinds, ids, roles, texts, dropped = (batch.column(names.index(c)).to_pylist() for c in ("conv", "kind", "conv_id", "role", "text", "dropped"))
        for i, this in enumerate(convs):
            if this != conv:
                if conv is not None:
                    out.append(done())
                conv, conv_id, head, repaired = this, None, None, None
            if kinds[i] == 0:
                head = {c: batch.column(names.index(c))[i].as_py() for c in (*_COUNTS, "audit")}
                repaired = Repaired(head["audit"])
                continue
            conv_id = ids[i]
            if not dropped[i]:
                repaired.row(roles[i], texts[i])
        if out:
            yield _emit(out, _OUT_ARROW)
    if conv is not None:
        yield _emit([done()], _OUT_ARROW)


def repair(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation (in the form of ``damaged`` or ``plain``).

    Rows of a conversation go by turn, null first, rows of one turn by role and the text's md5. A null id is a conversation like
    others, but one with an id that is a space, of which there is none among numbers; null roles and texts are a space. A role
    without a first letter, or with another than s, u or a, can't be kept. A conversation without rows has zeros, an empty audit and the hash of an empty text.
    """
    heads = audits(rows, piece)
    blank = lambda kind: F.lit(None).cast(kind)
    heads = heads.select("conv", F.lit(0).alias("kind"), F.lit(0).alias("_has"), F.lit(0).cast("long").alias("_turn"), blank("string").alias("role"), blank("string").alias("_hash"), blank("long").alias("conv_id"), F.lit(False).alias("dropped"), blank("string").alias("text"), *_COUNTS, "audit")
    body = _placed(rows).select("conv", F.lit(1).alias("kind"), "_has", "_turn", "role", "_hash", "conv_id", "dropped", "text", *(blank("long").alias(c) for c in _COUNTS), blank("string").alias("audit"))
    both = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
    return both.select("conv", "kind", "conv_id", "role", "text", "dropped", *_COUNTS, "audit").mapInArrow(lean(_hashed), _OUT)


def _best(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


#: The query over damaged conversations in DuckDB SQL: costs from each state of the role automaton (0 before all, 1 behind s, 2 behind
#: u, 3 behind a) to the end, from the last row to the first; of equal costs the audit that is less.
ORACLE = rf"""
WITH RECURSIVE t AS MATERIALIZED (SELECT list(list_reduce(list_prepend(i::BIGINT, [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS crc FROM range(256) r(i)),
ids AS MATERIALIZED (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv FROM conversations),
p AS MATERIALIZED (SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
f AS MATERIALIZED (SELECT p.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(t.crc[xor(c & 255, b) + 1], c >> 8)), 4294967295) % 20 AS fate FROM p, t),
d AS MATERIALIZED (SELECT conv, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM f, range(CASE WHEN fate = 3 THEN 2 ELSE 1 END) r(i) WHERE fate <> 0),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM d),
q AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) AS nth FROM o),
w AS MATERIALIZED (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault, substr(role, 1, 1) AS init,
  lag(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY pos) AS prev FROM q),
x AS MATERIALIZED (SELECT conv, pos, coalesce(fault IN ('blank', 'duplicate'), false) AS must, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS cut, init FROM w),
g AS (SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
  count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE prev || init NOT IN ('su', 'ua', 'au')) AS illegal FROM w GROUP BY conv),
s AS (
  SELECT conv, n + 1 AS pos, struct_pack(c := 0, a := '') AS s0, struct_pack(c := 4, a := 'II') AS s1, struct_pack(c := 2, a := 'I') AS s2, struct_pack(c := 0, a := '') AS s3 FROM g
  UNION ALL
  SELECT conv, pos, list_min([r0, struct_pack(c := q2.c + 2, a := 'I' || q2.a)]), list_min([r1, struct_pack(c := q2.c + 2, a := 'I' || q2.a)]), q2, q3 FROM (
    SELECT conv, pos, r0, r1, list_min([r2, struct_pack(c := r3.c + 2, a := 'I' || r3.a)]) AS q2, list_min([r3, struct_pack(c := r2.c + 2, a := 'I' || r2.a)]) AS q3 FROM (
      SELECT s.conv, x.pos,
        {_best("struct_pack(c := s0.c + 3, a := 'D' || s0.a)", "CASE WHEN NOT must AND init = 's' THEN struct_pack(c := s1.c + cut, a := 'K' || s1.a) END", "CASE WHEN NOT must AND init = 'u' THEN struct_pack(c := s2.c + cut, a := 'K' || s2.a) END", "CASE WHEN NOT must THEN struct_pack(c := s2.c + 2 + cut, a := 'R' || s2.a) END")} AS r0,
        {_best("struct_pack(c := s1.c + 3, a := 'D' || s1.a)", "CASE WHEN NOT must AND init = 'u' THEN struct_pack(c := s2.c + cut, a := 'K' || s2.a) END", "CASE WHEN NOT must THEN struct_pack(c := s2.c + 2 + cut, a := 'R' || s2.a) END")} AS r1,
        {_best("struct_pack(c := s2.c + 3, a := 'D' || s2.a)", "CASE WHEN NOT must AND init = 'a' THEN struct_pack(c := s3.c + cut, a := 'K' || s3.a) END", "CASE WHEN NOT must THEN struct_pack(c := s3.c + 2 + cut, a := 'R' || s3.a) END")} AS r2,
        {_best("struct_pack(c := s3.c + 3, a := 'D' || s3.a)", "CASE WHEN NOT must AND init = 'u' THEN struct_pack(c := s2.c + cut, a := 'K' || s2.a) END", "CASE WHEN NOT must THEN struct_pack(c := s2.c + 2 + cut, a := 'R' || s2.a) END")} AS r3
      FROM s JOIN x ON x.conv = s.conv AND x.pos = s.pos - 1))),
b AS MATERIALIZED (SELECT conv, s0.c AS cost, s0.a AS audit FROM s WHERE pos = 1),
e AS (SELECT conv, i, substr(audit, i, 1) AS ed, length(replace(audit, 'D', '')) AS outs, sum(CASE WHEN substr(audit, i, 1) <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY i) AS pos,
  sum(CASE WHEN substr(audit, i, 1) <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY conv ORDER BY i) AS nth FROM b, range(1, length(audit) + 1) r(i)),
h AS (SELECT e.conv, string_agg(CASE WHEN ed = 'K' THEN w.role WHEN (e.nth - outs % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN ed = 'I' THEN '' ELSE w.text END, chr(10) ORDER BY i) AS rep
  FROM e LEFT JOIN w ON w.conv = e.conv AND w.pos = e.pos WHERE ed <> 'D' GROUP BY e.conv)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(rep, '')) AS repaired_sha256
FROM ids LEFT JOIN g USING (conv) LEFT JOIN b USING (conv) LEFT JOIN h USING (conv)"""
