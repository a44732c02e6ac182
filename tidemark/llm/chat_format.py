"""Chat windows within a budget, in DataFrame expressions only.

Prefix sums of turn tokens cut a conversation into turn-aligned spans: a span is
the turns that begin in one stretch of the budget less system turn and history.
Its last turn may reach into the room for history; if it doesn't fit there
either, it is a span of its own.  A conversation that fits whole is one span.
Each span becomes a window: the system turn, as many turns before the span as
history and what is left of the budget allow, then the span.  Only the span's
own assistant texts are under the loss mask, so a target that is repeated as
history is not learnt twice.  A window is one string and its mask, a list of
(length, loss) runs.

One shuffle by conversation.  Its turns stay rows, each copied to the windows
that repeat it, so what is built in a row is bounded by a window's budget; only
the digest of a whole conversation isn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

#: Budgets in tokens, a token being four characters; each turn has one more for its markers.
BUDGET, HISTORY = 1024, 192
TURN, END, ESC = "<|turn|>", "<|end|>\n", "␛"
#: The control strings of common templates. An escape follows their first character.
CONTROL = r"(<)(?=\||s>|/s>|<SYS>>|</SYS>>|start_of_turn>|end_of_turn>|bos>|eos>|pad>|unk>)|(\[)(?=INST\]|/INST\])"


def escape(text: Column) -> Column:
    """Reversible: escapes are doubled, then control strings are broken by one."""
    return F.regexp_replace(F.replace(text, F.lit(ESC), F.lit(ESC * 2)), CONTROL, f"$1$2{ESC}")


def escape_role(role: Column) -> Column:
    """As texts; a role is one line."""
    return F.replace(escape(role), F.lit("\n"), F.lit(f"{ESC}n"))


def unescape(text: Column) -> Column:
    parts = F.split(text, ESC * 2, -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(F.replace(p, F.lit(f"{ESC}n"), F.lit("\n")), F.lit(ESC), F.lit(""))), ESC)


def tokens(text: Column) -> Column:
    return (F.ceil(F.length(text) / 4) + 1).cast("long")


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """``conv_id, window, repeated, formatted, mask``: one row a window.

    ``repeated`` is how many of a window's first turns were in earlier windows.
    A window exceeds the budget only if one turn does alone with the system turn.  Turns are in the
    order of (turn, role, text), nulls first; null roles and texts are empty;
    repeated rows are turns of their own; a null conv_id is one conversation; an
    empty table has no windows; other columns are ignored.
    """
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).withColumn("ord", F.row_number().over(w))
    lead = (F.col("ord") == 1) & (F.col("role") == "system")
    whole, by = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("ord")
    rows = rows.withColumn("lead", lead).withColumn("cost", F.when(lead, 0).otherwise(tokens(F.col("text"))))
    rows = rows.withColumn("system", F.max(F.when(F.col("lead"), tokens(F.col("text"))).otherwise(0)).over(whole)).withColumn("total", F.sum("cost").over(whole))
    rows = rows.withColumn("p", F.sum("cost").over(by) - F.col("cost"))
    room = F.lit(budget) - F.col("system")
    slot = F.when(F.col("total") <= room, 0).otherwise(F.floor(F.col("p") / F.greatest(F.lit(1), room - history)))
    rows = rows.withColumn("slot", slot)
    span = Window.partitionBy("conv_id", "slot")
    tail = (F.col("ord") == F.max("ord").over(span)) & (F.sum("cost").over(span) > room)
    rows = rows.withColumn("tail", tail)
    rows = rows.withColumn("size", F.when(F.col("tail"), F.col("cost")).otherwise(F.sum(F.when(~F.col("tail"), F.col("cost")).otherwise(0)).over(span)))
    before = F.lag(F.struct("slot", "tail")).over(by)
    rows = rows.withColumn("first", F.coalesce((before["slot"] != F.col("slot")) | before["tail"] | F.col("tail"), F.lit(True)))
    rows = rows.withColumn("window", F.sum(F.col("first").cast("int")).over(by) - 1)
    # The windows that begin within reach behind a turn and have room for it.
    back = F.least(F.lit(history), F.greatest(F.lit(0), room - F.col("size")))
    ahead = F.collect_list(F.when(F.col("first"), F.struct("window", (F.col("p") - back).alias("from")))).over(Window.partitionBy("conv_id").orderBy("p").rangeBetween(1, history))
    rows = rows.withColumn("ahead", F.when(F.col("lead"), F.array().cast("array<struct<window:bigint,from:bigint>>")).otherwise(F.filter(ahead, lambda w: w["from"] <= F.col("p"))))
    system = F.first(F.when(F.col("lead"), F.col("text")), ignorenulls=True).over(by)
    rows = rows.withColumn("system_text", F.when(F.col("first") & (F.col("window") > 0), system))
    shown = lambda w, o, role, text, own: F.struct(w.cast("long").alias("window"), o.cast("long").alias("ord"), role.alias("role"), text.alias("text"), F.lit(own).alias("own"))
    mine = F.array(shown(F.col("window"), F.col("ord"), F.col("role"), F.col("text"), True))
    again = F.transform("ahead", lambda w: shown(w["window"], F.col("ord"), F.col("role"), F.col("text"), False))
    led = F.when(F.col("system_text").isNotNull(), F.array(shown(F.col("window"), F.lit(0), F.lit("system"), F.col("system_text"), False))).otherwise(F.slice(mine, 1, 0))
    each = rows.select("conv_id", F.explode(F.concat(mine, again, led)).alias("x")).select("conv_id", "x.*")
    piece = F.struct("ord", F.concat(F.lit(TURN), escape_role(F.col("role")), F.lit("\n")).alias("head"), escape(F.col("text")).alias("body"), ((F.col("role") == "assistant") & F.col("own")).alias("loss"))
    made = each.groupBy("conv_id", "window").agg(F.sum((~F.col("own")).cast("int")).cast("int").alias("repeated"), F.sort_array(F.collect_list(piece)).alias("pieces"))
    run = lambda size, loss: F.struct(size.alias("length"), loss.alias("loss"))
    mask = F.flatten(F.transform("pieces", lambda x: F.array(run(F.length(x["head"]), F.lit(False)), run(F.length(x["body"]), x["loss"]), run(F.lit(len(END)), F.lit(False)))))
    text = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    return made.select("conv_id", F.col("window").cast("int").alias("window"), "repeated", text.alias("formatted"), mask.alias("mask"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) of a window, unescaped."""
    raw = F.slice(F.split(formatted, r"<\|turn\|>", -1), 2, 1 << 30)
    return F.transform(raw, lambda t: F.struct(unescape(F.substring_index(t, "\n", 1)).alias("role"), unescape(F.substring(t, F.length(F.substring_index(t, "\n", 1)) + 2, F.length(t) - F.length(F.substring_index(t, "\n", 1)) - 1 - len(END))).alias("text")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """The unescaped text under the mask, run by run."""
    zero = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("found"))

    def step(acc: Column, m: Column) -> Column:
        found = F.when(m["loss"], F.concat(acc["found"], F.array(unescape(F.substring(formatted, acc["at"], m["length"]))))).otherwise(acc["found"])
        return F.struct((acc["at"] + m["length"]).alias("at"), found.alias("found"))

    return F.aggregate(mask, zero, step, lambda acc: F.array_join(acc["found"], ""))


def digest(windows: DataFrame) -> DataFrame:
    """What a conversation's windows hold, read from their strings and masks."""
    turns = F.slice(read_turns(F.col("formatted")), F.col("repeated") + 1, 1 << 30)
    flat = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = windows.select("conv_id", "window", F.size(turns).cast("long").alias("n"), flat.alias("flat"), read_loss(F.col("formatted"), F.col("mask")).alias("loss"), F.length("formatted").cast("long").alias("chars"))
    whole = each.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("window", "flat", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    joined = lambda c: F.array_join(F.transform("w", lambda x: x[c]), "")
    return whole.select("conv_id", "n_turns", F.sha2(joined("flat"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")


def chat_format(conversations: DataFrame) -> DataFrame:
    """The digest of all conversations, from their windows as written and read again."""
    return digest(common.written(chat_windows(conversations), "windows"))


ORACLE = rf"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS ord, (ceil(length(text) / 4.0) + 1)::BIGINT AS t,
      length(text) + len(regexp_extract_all(text, '<\||<s>|</s>|<<SYS>>|<</SYS>>|<start_of_turn>|<end_of_turn>|<bos>|<eos>|<pad>|<unk>|\[INST\]|\[/INST\]')) + len(regexp_extract_all(text, '{ESC}'))
      + length(role) + {len(TURN) + 1 + len(END)} AS chars FROM c),
k AS (SELECT *, CASE WHEN ord = 1 AND role = 'system' THEN 0 ELSE t END AS cost, max(CASE WHEN ord = 1 AND role = 'system' THEN t ELSE 0 END) OVER (PARTITION BY conv_id) AS sys,
      max(CASE WHEN ord = 1 AND role = 'system' THEN chars ELSE 0 END) OVER (PARTITION BY conv_id) AS sys_chars FROM o),
p AS (SELECT *, (sum(cost) OVER (PARTITION BY conv_id ORDER BY ord) - cost)::BIGINT AS p, sum(cost) OVER (PARTITION BY conv_id) AS total FROM k),
s AS (SELECT *, CASE WHEN total <= {BUDGET} - sys THEN 0 ELSE p // greatest(1, {BUDGET - HISTORY} - sys) END AS slot FROM p),
u AS (SELECT *, ord = max(ord) OVER w AND sum(cost) OVER w > {BUDGET} - sys AS tail FROM s WINDOW w AS (PARTITION BY conv_id, slot)),
v AS (SELECT *, CASE WHEN tail THEN cost ELSE sum(CASE WHEN tail THEN 0 ELSE cost END) OVER (PARTITION BY conv_id, slot) END AS size,
      coalesce(lag(slot) OVER w <> slot OR lag(tail) OVER w OR tail, true) AS first FROM u WINDOW w AS (PARTITION BY conv_id ORDER BY ord)),
f AS (SELECT *, least({HISTORY}, greatest(0, {BUDGET} - sys - size)) AS back FROM v),
r AS (SELECT a.conv_id, a.ord, sum(b.chars) FILTER (WHERE b.ord < a.ord AND b.cost > 0 AND b.p >= a.p - a.back) AS hist, any_value(CASE WHEN a.ord > 1 THEN a.sys_chars ELSE 0 END) AS again
      FROM f a LEFT JOIN f b ON a.conv_id IS NOT DISTINCT FROM b.conv_id WHERE a.first GROUP BY a.conv_id, a.ord),
e AS (SELECT conv_id, sum(coalesce(hist, 0) + again) AS extra FROM r GROUP BY conv_id),
g AS (SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY ord)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY ord) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256, sum(chars) AS own FROM f GROUP BY conv_id)
SELECT g.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, (own + extra)::BIGINT AS formatted_chars FROM g JOIN e ON g.conv_id IS NOT DISTINCT FROM e.conv_id"""
