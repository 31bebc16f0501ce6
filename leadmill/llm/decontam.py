"""Benchmark decontamination by spaced seeds.

Texts become arrays of token hashes (lower-cased runs of letters and digits).  A spaced seed is a fixed mask that
looks at six tokens of a window and ignores those between, so a substituted token spoils only the windows and
masks that look at it.  Windows of training texts meet those of benchmark items on (mask, hash); each hit fixes how
item and text lie against each other, and around it the whole item is compared token by token:

* the item is there if at least ITEM_SHARE of its tokens agree in place (all of them if it has fewer than 8), or
* a part of it is there if some stretch scores PART_SCORE, a match counting 1 and a substitution -2.

Items shorter than a mask use the mask cut to their length.  Only the benchmark side is broadcast, after its windows
were measured; beyond BROADCAST_BYTES the join shuffles.  Every position of every text is looked up; what is
verified leaves the task as counts.  No Python runs on the executors.

Defined results: null and empty texts and items match nothing; a null doc_id or item_id is a value like any other;
repeated rows give one result row; several places of one item give the best; texts of any length are read whole (a text's
token hashes are one value, eight bytes a token); an empty table gives no rows; other columns stay, none is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: The token positions that each mask looks at.
MASKS = ((0, 1, 3, 4, 7, 9), (0, 2, 3, 5, 8, 10), (0, 1, 5, 6, 7, 10), (0, 2, 4, 5, 6, 9))
SPAN = 1 + max(m[-1] for m in MASKS)
ITEM_SHARE, PART_SCORE = 0.7, 13
#: Bytes of benchmark windows, each with its item's tokens, that may be broadcast.
BROADCAST_BYTES = 64 << 20


def tokens(text: Column) -> Column:
    """Hashes of the text's tokens in order; null: none."""
    return F.transform(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), ""), lambda t: F.xxhash64(t))


def cut_masks(lengths: list[int]) -> list[tuple[int, ...]]:
    """MASKS, and for items shorter than SPAN each mask cut to the item's length."""
    return [*MASKS, *sorted({tuple(o for o in m if o < n) for n in lengths if n < SPAN for m in MASKS})]


def seeds(th: str, at: Column, masks: list[tuple[int, ...]]) -> Column:
    """The hashes of the window at a position, one for each mask."""
    return F.array(*[F.xxhash64(F.lit(k), *[F.get(th, at + o) for o in m]) for k, m in enumerate(masks)])


def positions(th: str) -> Column:
    return F.explode(F.when(F.size(th) > 0, F.sequence(F.lit(0), F.size(th) - 1)))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, h, item_id, matched, item_tokens, part_score, place): the best verified place of each text and item; h is a hash of the text.

    What verifies is chosen after the grouping: a filter below it would move into the join and take it, and all
    positions with it, out of generated code.
    """
    items = benchmark.select("item_id", tokens(F.col("text")).alias("ith")).where("size(ith) > 0").distinct()
    lengths = [r[0] for r in items.select(F.size("ith").alias("n")).where(f"n < {SPAN}").distinct().collect()]  # at most SPAN values
    masks = cut_masks(lengths)
    # A window counts for a mask that it fills; a cut mask stands for the items of its length alone.
    fits = F.array(*[(F.col("pos") + m[-1] < F.size("ith")) & (F.lit(k < len(MASKS)) | (F.size("ith") < SPAN)) for k, m in enumerate(masks)])
    test = items.select("item_id", "ith", positions("ith").alias("pos")).select("item_id", "ith", "pos", fits.alias("fits"), F.posexplode(seeds("ith", F.col("pos"), masks)).alias("k", "seed"))
    test = test.where(F.get("fits", "k")).select("seed", "item_id", "ith", "pos")
    keys = test.groupBy("seed", "item_id", "ith").agg(F.collect_set("pos").alias("pos"))
    held = keys.agg(F.sum(F.size("pos") * (8 * F.size("ith").cast("long") + 40))).first()[0] or 0
    small = held <= BROADCAST_BYTES
    train = docs.select("doc_id", F.xxhash64("text").alias("h"), tokens(F.col("text")).alias("th"))
    lines = train.select("doc_id", "h", "th", positions("th").alias("i")).select("doc_id", "h", "th", "i", F.explode(seeds("th", F.col("i"), masks)).alias("seed"))
    place = F.col("i") - F.col("pos")
    if small:  # texts stay where they are, and their tokens with them; one projection right above the join is in its generated code
        keys = keys.select("seed", "item_id", "ith", F.explode("pos").alias("pos"))
        around = F.slice("th", F.greatest(place, F.lit(0)) + 1, F.size("ith")).alias("around")
        met = lines.join(F.broadcast(keys), "seed").select("doc_id", "h", "item_id", "ith", place.alias("place"), around)
    else:  # windows travel without tokens; those come back for the places that met
        keys = written(keys.select("seed", "item_id", F.explode("pos").alias("pos")), "windows")  # a join right above a grouping can't have its hot keys split
        places = lines.select("doc_id", "h", "i", "seed").join(keys, "seed").select("doc_id", "h", "item_id", place.alias("place")).distinct().alias("p")
        held = train.dropDuplicates(["doc_id", "h"]).alias("t")
        met = places.join(held, F.col("p.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("p.h") == F.col("t.h"))).select("p.*", "t.th").alias("m")
        around = F.slice("th", F.greatest(F.col("place"), F.lit(0)) + 1, F.size("ith")).alias("around")
        met = met.join(items.alias("n"), F.col("m.item_id").eqNullSafe(F.col("n.item_id"))).select("doc_id", "h", "m.item_id", "ith", "place", around)
    same = F.transform(F.sequence(F.lit(0), F.size("ith") - 1), lambda p: F.coalesce(F.get("ith", p) == F.get("around", p + F.least(F.col("place"), F.lit(0))), F.lit(False)))
    met = met.select("doc_id", "h", "item_id", "place", same.alias("same"))
    best = F.aggregate("same", F.struct(F.lit(0).alias("run"), F.lit(0).alias("best")), lambda s, x: F.struct(_step(s, x).alias("run"), F.greatest(s["best"], _step(s, x)).alias("best")))["best"]
    matched = F.size(F.filter("same", lambda x: x))
    got = met.select("doc_id", "h", "item_id", "place", matched.cast("long").alias("matched"), F.size("same").cast("long").alias("item_tokens"), best.cast("long").alias("part_score"))
    share = F.when(F.col("item_tokens") < 8, F.lit(1.0)).otherwise(F.lit(ITEM_SHARE))
    found = (F.col("matched") >= share * F.col("item_tokens")) | (F.col("part_score") >= PART_SCORE)
    got = got.groupBy("doc_id", "h", "item_id").agg(F.max(F.struct(found.alias("found"), "matched", "part_score", (-F.col("place")).alias("back"), "item_tokens")).alias("b"))
    return got.where("b.found").select("doc_id", "h", "item_id", "b.matched", "b.item_tokens", "b.part_score", (-F.col("b.back")).cast("long").alias("place"))


def _step(s: Column, x: Column) -> Column:
    return F.greatest(F.lit(0), s["run"] + F.when(x, 1).otherwise(-2))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matched, item_tokens, part_score, place): one row for each document and item found in it."""
    best = F.max(F.struct("matched", "part_score", "place", "item_tokens")).alias("b")
    return hits(docs, benchmark).groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.matched", "b.item_tokens", "b.part_score", "b.place")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found."""
    bad = hits(docs, benchmark).select("doc_id", "h").distinct().alias("b")
    rows = docs.withColumn("__h", F.xxhash64("text")).alias("d")
    return rows.join(bad, F.col("d.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("d.__h") == F.col("b.h")), "left_anti").select(*docs.columns)
