"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a token budget.  Whole passes over the source are taken first; what remains is fitted from its
documents: counted by exact length, most of the remainder is taken evenly over the lengths, and the last stretch
by a bounded-knapsack dynamic program over the leftover counts.  The program says how many documents of each
length to add; which ones is decided by a seeded hash.

Only histograms (source, length, count) are gathered, one source to a task; they hold at most as many rows as a
source has distinct lengths.  Documents are ranked in sub-groups of bounded size, so that one length of one
source may hold any part of the rows.

Defined results: a null text has size 0; null sources are a source of their own, last in order; rows of size 0 are
taken by whole passes only and add nothing; an empty table gives no rows; rows equal in doc_id, source and size
are interchangeable; texts of any length are counted whole (a length is one row of a histogram, whatever it is);
other columns stay, and those that the mix adds to its own tables can't meet them.  The same input and seed give the same mix.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE, local_table, written

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SEED = 17
#: The dynamic program fits remainders up to this many tokens; whatever is above is taken evenly first.
STRETCH = 1 << 15
#: Documents of one length of one source that are ranked together.
GROUP = 512
#: Sources that may come to the driver, where the budgets are set; more raise an error.
MOST_SOURCES = 1_000_000


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of the text; null: 0."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE), "")), F.lit(0)).cast("long")


def budgets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets by weight of share * sum(sizes); none above most * its size, the excess dealt again by weight."""
    caps = [float(most * s) for s in sizes]
    target, left, open_ = [0.0] * len(sizes), share * float(sum(sizes)), set(range(len(sizes)))
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    while open_:
        unit = left / sum(w[i] for i in open_)
        over = {i for i in open_ if unit * w[i] > caps[i]}
        if not over:
            for i in open_:
                target[i] = unit * w[i]
            break
        for i in over:
            target[i] = caps[i]
            left -= caps[i]
        left, open_ = max(left, 0.0), open_ - over
    return target


def fitted(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each length to take, at most counts, so that the tokens come as near below budget as they can."""
    take = np.zeros(len(lengths), np.int64)
    usable = np.flatnonzero((lengths > 0) & (lengths <= budget))
    if not len(usable):
        return take
    size, have = lengths[usable].astype(np.int64), counts[usable].astype(np.int64)
    got = np.zeros(len(usable), np.int64)
    total = int(size @ have)
    if total <= budget:
        take[usable] = have
        return take
    even = max(0.0, budget - STRETCH / 2) / total  # evenly over the lengths, by the running share
    got = np.diff(np.floor(np.concatenate([[0], np.cumsum(have)]) * even).astype(np.int64))
    for i in range(len(size) - 1, -1, -1):  # the running shares may run over by a long document or two
        over = int(size @ got) - budget
        if over <= 0:
            break
        got[i] -= min(got[i], -(-over // int(size[i])))
    rest = budget - int(size @ got)
    for i in np.argsort(-size, kind="stable"):
        if rest <= STRETCH:
            break
        n = min(int(have[i] - got[i]), max(0, rest - STRETCH // 2) // int(size[i]))
        got[i] += n
        rest -= n * int(size[i])
    got += knapsack(size, have - got, rest)
    take[usable] = got
    return take


def knapsack(size: np.ndarray, have: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset-sum: counts by size whose sum is the largest reachable up to budget."""
    reached = np.zeros(budget + 1, bool)
    reached[0] = True
    by = np.full(budget + 1, -1, np.int32)
    items: list[tuple[int, int]] = []
    for i in np.flatnonzero((have > 0) & (size <= budget)):
        left, n = min(int(have[i]), budget // int(size[i])), 1
        while left and not reached[budget]:  # powers of two stand for any number
            n = min(n, left)
            w = n * int(size[i])
            if w <= budget:
                new = reached[: budget + 1 - w] & ~reached[w:]
                by[w:][new] = len(items)
                reached[w:] |= new
                items.append((int(i), n))
            left, n = left - n, 2 * n
        if reached[budget]:
            break
    got, at = np.zeros(len(size), np.int64), int(np.flatnonzero(reached)[-1])
    while at:
        i, n = items[by[at]]
        got[i] += n
        at -= n * int(size[i])
    return got


def plan(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, size, n, source_size, target, passes, extra): documents of a size, whole passes, and how many get one more."""
    spark = sized.sparkSession
    histogram = written(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "lengths")
    sums = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    rows = sums.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))
    targets = budgets([r.source_size for r in rows], weights, share, most)
    known = local_table(spark, {"s": pa.array([r.source for r in rows], pa.string()), "source_size": pa.array([r.source_size for r in rows], pa.int64()), "target": pa.array(targets, pa.float64())})
    joined = histogram.join(F.broadcast(known) if len(rows) <= 10_000 else known, F.col("source").eqNullSafe(F.col("s"))).drop("s")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size", ignore_index=True)
        total, target = int(pdf.source_size.iloc[0]), float(pdf.target.iloc[0])
        passes = int(target // total) if total else 0
        extra = fitted(pdf["size"].to_numpy(), pdf["n"].to_numpy(), round(target - passes * total)) if passes < most else 0
        return pdf.assign(passes=passes, extra=extra)

    return joined.groupBy("source").applyInPandas(fit, "source string, size long, n long, source_size long, target double, passes int, extra long")


def mixed(sized: DataFrame, order: list[str], **how) -> DataFrame:
    """sized (source, size and more) with source_size, target and times: how often the mix takes the row.

    `order`: columns whose seeded hash decides which documents of a length are taken.
    """
    by = written(plan(sized, **how), "plan")
    rows = sized.withColumn("u", F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *order), 11) / float(1 << 53)).alias("d")
    k = by.alias("k")
    rows = rows.join(k, F.col("d.source").eqNullSafe(F.col("k.source")) & (F.col("d.size") == F.col("k.size")))
    rows = rows.select("d.*", "k.source_size", "k.target", "k.passes", "k.extra", F.floor(F.col("u") * F.ceil(F.col("n") / GROUP)).alias("part"))
    sure = rows.where("extra = 0").withColumn("times", F.col("passes").cast("long"))
    chosen = rows.where("extra > 0")
    parts = chosen.groupBy("source", "size", "part").agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(W.partitionBy("source", "size").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("before", before).alias("p")
    chosen = chosen.withColumn("rank", F.row_number().over(W.partitionBy("source", "size", "part").orderBy("u", *order))).alias("c")
    chosen = chosen.join(parts, F.col("c.source").eqNullSafe(F.col("p.source")) & (F.col("c.size") == F.col("p.size")) & (F.col("c.part") == F.col("p.part")))
    chosen = chosen.select("c.*", (F.col("c.passes") + (F.col("c.rank") + F.col("p.before") <= F.col("c.extra")).cast("long")).alias("times"))
    return sure.unionByName(chosen.drop("rank")).drop("u", "part", "passes", "extra")


def digests(docs: DataFrame) -> DataFrame:
    sized = written(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "sized")
    return mixed(sized, ["doc_id"]).select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def mixture(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each as often as it is taken.  Rows of one doc_id share their number of times."""
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("h"))
    times = mixed(written(sized, "sized"), ["doc_id", "h"], **how).where("times > 0")
    # Written, so that the join has no grouping right below it and a document in many rows can be split.
    times = written(times.groupBy("doc_id", "h").agg(F.max("times").alias("times")), "times").alias("t")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # columns of any name stay as they are
    rows = docs.select(row, F.col("doc_id").alias("id"), F.xxhash64("text").alias("h")).alias("d").join(times, F.col("d.id").eqNullSafe(F.col("t.doc_id")) & (F.col("d.h") == F.col("t.h")))
    return rows.select("d.row", F.explode(F.sequence(F.lit(1).cast("long"), "t.times"))).select("row.*")
