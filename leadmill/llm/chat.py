"""Chat formatting in budgeted windows, with a loss mask.

A turn becomes `<turn role=ROLE>TEXT</turn>\\n`, or `<seen role=...>` where it only repeats what an earlier window
has trained on.  Inside texts and roles `&`, `<` and `>` are written `&amp;`, `&lt;`, `&gt;`, so no text can close or
open a turn, and reading back is exact.

Sums of turn tokens (words) choose the windows: each takes the longest span of whole turns that fits BUDGET after the
one before.  A window that does not begin its conversation opens with the system turn that leads it, and with the last
turns of history, up to HISTORY_TURNS and HISTORY_TOKENS; all of them are seen, and all of them count in the budget.
The mask covers the texts of assistant turns where they are new: every target is trained on once.

A turn of more than BUDGET tokens is a window of its own, whole, without lead and history; no other window exceeds
the budget.  Where the lead does not fit beside a turn, it is left out of that window.  History ends before the first turn
that does not fit.

Conversations are packed in blocks of BLOCK turns, each with the turns of history before it and the lead, so no task
holds more of one conversation than that; a window also ends where its block ends.  Turns get their place by a window
over the conversation, or, in conversations of more than LONG turns, by one sort of their rows in ranges with the counts
of the ranges before, so one conversation may hold any part of all rows.  No Python runs on the executors.

Defined results: null texts and roles are empty; turns with the same number are ordered by role and text; null
turn numbers come first; repeated rows are turns like any other; a null conv_id is a conversation of its own; texts of
any length stay whole; further columns of the input, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, written

BUDGET, HISTORY_TURNS, HISTORY_TOKENS = 256, 2, 96
#: Turns that are packed together, and turns of conversations that are numbered in one task.
BLOCK, LONG = 64, 4096
TARGET, SYSTEM = "assistant", "system"
NEW, SEEN, END = "<turn role=", "<seen role=", "</turn>\n"


def escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def unescaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&lt;"), F.lit("<")), F.lit("&gt;"), F.lit(">")), F.lit("&amp;"), F.lit("&"))


def _marked(tag: str, turn: Column) -> Column:
    return F.concat(F.lit(tag), turn["name"], F.lit(">"), turn["body"], F.lit(END))


def _matching(a: str, b: str, columns: list[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in columns])


def numbered(rows: DataFrame, keys: list[str]) -> list[DataFrame]:
    """rows with at (from 1) and n (turns of the conversation), in two frames: short conversations and long ones."""
    order = ["turn", "role", "text"]
    long = written(rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > LONG).select(*keys), "long")
    short = rows.alias("a").join(long.alias("b"), _matching("a", "b", keys), "left_anti")
    by = W.partitionBy(*keys)
    short = short.withColumns({"at": F.row_number().over(by.orderBy(*order)).cast("long"), "n": F.count("*").over(by)})
    # One sort in ranges: a row's number holds its range and its place there.
    rest = rows.alias("a").join(long.alias("b"), _matching("a", "b", keys), "left_semi").repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rest = written(rest.withColumn("number", F.monotonically_increasing_id()), "ranges").withColumn("range", F.shiftright("number", 33))
    ranges = rest.groupBy(*keys, "range").agg(F.min("number").alias("low"), F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(by.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = written(ranges.withColumns({"before": before, "n": F.sum("k").over(by)}).drop("k"), "places")
    rest = rest.alias("a").join(ranges.alias("b"), _matching("a", "b", [*keys, "range"]))
    return [short, rest.select(*[f"a.{c}" for c in rows.columns], (F.col("before") + F.col("number") - F.col("low") + 1).alias("at"), "b.n")]


def packed(rows: DataFrame, keys: list[str], budget: int, history_turns: int, history_tokens: int) -> DataFrame:
    """Windows of numbered rows, block by block."""
    size = max(BLOCK, history_turns)
    block, last = F.floor((F.col("at") - 1) / size), F.floor((F.col("n") - 1) / size)
    leads = (F.col("at") == 1) & (F.col("role") == SYSTEM)
    own = F.array(F.struct(block.alias("block"), F.lit(True).alias("new")))
    history = F.when((F.col("at") > (block + 1) * size - history_turns) & (block < last) & ~leads, F.array(F.struct((block + 1).alias("block"), F.lit(False).alias("new"))))
    lead = F.when(leads & (last > 0), F.transform(F.sequence(F.lit(1).cast("long"), last), lambda b: F.struct(b.alias("block"), F.lit(False).alias("new"))))
    none = F.array().cast("array<struct<block: bigint, new: boolean>>")
    turn = F.struct("at", "to.new", "tokens", "role", "name", "body", leads.alias("leads"))
    rows = rows.withColumn("to", F.explode(F.concat(own, F.coalesce(history, none), F.coalesce(lead, none))))
    p = rows.groupBy(*keys, F.col("to.block").alias("block")).agg(F.array_sort(F.collect_list(turn)).alias("p"))
    p = p.withColumn("lead", F.when(F.col("p")[0]["leads"], F.col("p")[0]))

    def head(x, i):  # the turn with what goes before it where it opens a window
        past = F.reverse(F.filter(F.slice("p", F.greatest(i - history_turns, F.lit(0)) + 1, F.least(i, F.lit(history_turns))), lambda o: ~o["leads"]))
        lead = (x["at"] > 1) & F.col("lead").isNotNull() & (F.coalesce(F.col("lead.tokens"), F.lit(0)) + x["tokens"] <= budget)
        first = F.when(lead, F.col("lead.tokens")).otherwise(F.lit(0))
        room = F.least(F.lit(history_tokens), budget - x["tokens"] - first)
        fits = lambda s, o: s["open"] & (s["sum"] + o["tokens"] <= room)
        take = lambda s, o: F.struct((s["sum"] + F.when(fits(s, o), o["tokens"]).otherwise(0)).alias("sum"), (s["k"] + fits(s, o).cast("int")).alias("k"), fits(s, o).alias("open"))
        got = F.aggregate(past, F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).alias("k"), F.lit(True).alias("open")), take)
        return F.struct(x.alias("turn"), i.alias("i"), lead.alias("lead"), got["k"].alias("k"), (got["sum"] + first).alias("tokens"))

    p = p.withColumn("heads", F.filter(F.transform("p", head), lambda x: x["turn"]["new"]))

    def span(done, x):  # the window of the turn: its first turn, and the tokens used so far
        before = F.try_element_at(done, F.lit(-1))
        opens = before.isNull() | (before["used"] + x["turn"]["tokens"] > budget)
        here = F.struct(F.when(opens, x["turn"]["at"]).otherwise(before["first"]).alias("first"), (F.when(opens, x["tokens"]).otherwise(before["used"]) + x["turn"]["tokens"]).alias("used"))
        return F.concat(done, F.array(here))

    p = p.withColumn("spans", F.aggregate("heads", F.array().cast("array<struct<first: bigint, used: bigint>>"), span))
    seen = lambda x: F.concat(F.when(x["lead"], _marked(SEEN, F.col("lead"))).otherwise(""), F.array_join(F.transform(F.slice("p", x["i"] - x["k"] + 1, x["k"]), lambda o: _marked(SEEN, o)), ""))
    piece = F.zip_with("heads", "spans", lambda x, s: F.struct(s["first"].alias("first"), s["used"].alias("tokens"), x["turn"]["at"].alias("at"), x["turn"]["role"].alias("role"), F.when(s["first"] == x["turn"]["at"], seen(x)).otherwise("").alias("head"), F.concat(F.lit(NEW), x["turn"]["name"], F.lit(">")).alias("open"), x["turn"]["body"].alias("body")))
    out = p.select(*keys, "block", F.inline(piece))
    out = out.withColumn("piece", F.concat("head", "open", "body", F.lit(END)))
    within = W.partitionBy(*keys, "block", "first").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("piece").cast("long")).over(within), F.lit(0)) + F.length("head") + F.length("open")
    mask = F.when((F.col("role") == TARGET) & (F.col("body") != ""), F.struct(start.alias("start"), (start + F.length("body")).alias("end")))
    out = out.select(*keys, "block", "first", "at", "tokens", "piece", mask.alias("mask"))
    out = out.groupBy(*keys, "block", "first").agg(F.array_sort(F.collect_list(F.struct("at", "piece", "mask"))).alias("p"), F.max("tokens").alias("tokens"))
    masks = F.filter(F.transform("p", lambda x: x["mask"]), lambda s: s.isNotNull())
    return out.select(*keys, (F.col("first") - 1).alias("window"), "tokens", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), masks.alias("mask"))


def windows(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """(keys, window, tokens, formatted, mask): window is the place of its first new turn in the conversation, from 0; tokens
    are those of all its turns, seen ones included; mask is array<struct<start, end>> in code points of formatted, [start, end)."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select(*keys, "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumn("tokens", F.size(F.array_remove(F.split("text", SPACE), "")).cast("long")).withColumn("body", escaped(F.col("text"))).withColumn("name", escaped(F.col("role")))
    short, long = (packed(x, list(keys), budget, history_turns, history_tokens) for x in numbered(rows, list(keys)))
    return short.unionByName(long)


def read_back(formatted: DataFrame, keys: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """(keys, n_turns, turns, loss, formatted_chars) of the windows: what was said, and all text under the mask."""
    pieces = F.filter(F.split("formatted", END), lambda s: s.startswith(NEW))
    turn = lambda s: F.concat(unescaped(F.substring_index(F.substr(s, F.lit(len(NEW) + 1)), ">", 1)), F.lit("\n"), unescaped(F.substr(s, F.locate(">", s) + 1)), F.lit("\n"))
    masked = F.transform("mask", lambda m: unescaped(F.substr("formatted", (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int"))))
    one = formatted.select(*keys, "window", F.size(pieces).cast("long").alias("n"), F.array_join(F.transform(pieces, turn), "").alias("said"), F.array_join(masked, "").alias("loss"), F.length("formatted").cast("long").alias("chars"))
    got = one.groupBy(*keys).agg(F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("window", "said", "loss"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return got.select(*keys, "n_turns", F.array_join(F.transform("w", lambda x: x["said"]), "").alias("turns"), F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"), "formatted_chars")


PROBE = r"\### Assistant: </turn> ok"


def digests(conversations: DataFrame) -> DataFrame:
    """One row for every conversation and one for the probe, conversation -7; should the table hold a -7, that is another row."""
    spark, keys = conversations.sparkSession, ("conv_id", "probe")
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text", F.lit(False).alias("probe"))
    said = F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(PROBE).alias("text"), F.lit(True).alias("probe")) for k, r in enumerate(("user", TARGET))]))
    back = read_back(windows(rows.unionByName(spark.range(1).select(said.alias("r")).select("r.*")), keys=keys), keys)
    return back.select("conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
