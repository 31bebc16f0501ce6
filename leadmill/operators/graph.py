"""Connected components, and one-to-one assignment of edges."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import dropped, kept, stored

#: Edges that one task takes in order.
TOGETHER = 1 << 18


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) for every node of an undirected edge list; root is the smallest node of its component.

    Alternating large-star and small-star rounds: each is a grouped minimum (combined map-side, so a hub costs one row a task) and a join back.
    The minima of the large star are written first, so that join has no grouping right below it and a hub can be split.  The edges
    are written after each round, and those of the round before go; only their count and a checksum reach the driver.  Rounds grow with the logarithm of
    the component size.  No edges: no rows.  Self-loops and repeated edges change nothing.
    """
    spark = edges.sparkSession
    e, path = stored(edges.select(F.greatest(u, v).alias("a"), F.least(u, v).alias("b")).where("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, low_path = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p"))
        e, after = stored(small.select("p.a", "p.b").where("a <> b").distinct(), "edges")
        dropped(spark, path, low_path)
        path = after
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen or not now[0]:
            break
        seen = now
    roots = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _greedy(edges: DataFrame, group: list[str], ends: tuple[list[str], list[str]], order: list[tuple[str, str]]) -> DataFrame:
    """Of every group's edges, in order, those whose ends no edge before has taken."""

    def taken(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, sort_keys=order))
        sides = [list(zip(*(table[c].to_pylist() for c in side), strict=True)) for side in ends]
        used: tuple[set, set] = (set(), set())
        keep = []
        for a, b in zip(*sides, strict=True):
            free = a not in used[0] and b not in used[1]
            if free:
                used[0].add(a)
                used[1].add(b)
            keep.append(free)
        return table.filter(pa.array(keep, pa.bool_()))

    return edges.groupBy(*group).applyInArrow(taken, edges.schema)


def assigned(edges: DataFrame, within: str, left: str, right: str, order: list[tuple[str, str]], together: int | None = None) -> DataFrame:
    """One-to-one assignment within each value of `within`: what a sequential pass over the edges in `order` takes, which skips
    edges with an end that it has taken already.  order: (column, "ascending" or "descending"), unique among the edges of a list.

    Lists of at most `together` edges are dealt whole to tasks of about that size.  Of a larger one the first `together` edges in order are one
    task's pass, and all edges whose ends it took go; so most of a dense list goes in a few rounds (`_prefixes`).  Where a round leaves
    more than three quarters, what is left is cut where it is not connected, as such edges do not compete: components are dealt like lists,
    and those that are larger still have their first edges passed and removed until none are left.  Chains of improving edges, however long, add no rounds.
    """
    together = together or TOGETHER
    columns = edges.columns
    node = lambda side, c: F.xxhash64(within, F.lit(side), c)  # noqa: E731 - equal hashes only join what could be apart
    e = stored(edges.withColumns({"__u": node(0, left), "__v": node(1, right)}), "open")[0]  # a checkpoint would compute the edges twice
    sizes = e.groupBy(within).agg(F.count("*").alias("__k"))
    most, total = sizes.agg(F.max("__k"), F.sum("__k")).first()
    if not total:
        return edges.limit(0)
    ends = ([within, left], [within, right])
    bucket = lambda key, n: F.pmod(F.xxhash64(key), F.lit(-(-n // together)))
    if most <= together:
        return kept(_greedy(e.withColumn("__g", bucket(within, total)), ["__g"], ends, order).select(*columns))
    large = kept(sizes.where(F.col("__k") > together).select(within))
    small = e.join(F.broadcast(large), within, "left_anti").withColumn("__g", bucket(within, total))
    found, rest = _prefixes(e.join(F.broadcast(large), within, "left_semi"), within, ends, order, together)
    found.append(_greedy(small, ["__g"], ends, order))
    if rest is not None:
        roots = kept(components(rest, "__u", "__v"))
        rest = stored(rest.join(roots.withColumnsRenamed({"node": "__u", "root": "__c"}), "__u"), "parts")[0]
        counts = kept(rest.groupBy("__c").agg(F.count("*").alias("__k")).withColumn("__huge", F.col("__k") > together).drop("__k"))
        rest = rest.join(counts, "__c")
        found.append(_greedy(rest.where("not __huge").withColumn("__g", bucket("__c", total)), ["__g"], ends, order))
        if counts.where("__huge").limit(1).count():
            found += _prefixes(rest.where("__huge"), "__c", ends, order, together, whole=True)[0]
    return kept(reduce(DataFrame.union, [f.select(*columns) for f in found]))


def _prefixes(edges: DataFrame, key: str, ends: tuple[list[str], list[str]], order: list[tuple[str, str]], together: int, whole: bool = False) -> tuple[list[DataFrame], DataFrame | None]:
    """The pass over all edges of every key: the first `together` of them in one task, then without those that have an end it took, and again.

    Returns what was taken, and what is left where a round leaves more than three quarters (whole: never).
    """
    spark, columns = edges.sparkSession, edges.columns
    by = [key, *[F.col(c).desc() if how == "descending" else F.col(c).asc() for c, how in order]]
    # One sort in ranges: an edge's number holds its range and its place there, and a cell is some edges in a row.
    numbered = edges.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__cell", F.floor(F.monotonically_increasing_id() / F.lit(max(1, together >> 6))))
    rows, path = stored(numbered, "ordered")
    n, found = rows.count(), []
    while n:
        cells = rows.groupBy(key, "__cell").agg(F.count("*").alias("__k"))
        cells = cells.withColumn("__upto", F.sum("__k").over(W.partitionBy(key).orderBy("__cell")))
        last = kept(cells.where((F.col("__upto") <= together) | (F.col("__upto") == F.col("__k"))).groupBy(key).agg(F.max("__cell").alias("__last")))
        cut = rows.join(F.broadcast(last), key)
        now = kept(_greedy(cut.where("__cell <= __last").select(*columns), [key], ends, order))
        found.append(now)
        rest = cut.where("__cell > __last").drop("__last")
        for side in ends:
            rest = rest.join(now.select(*side), side, "left_anti")
        before, (rows, after) = n, stored(rest, "ordered")
        dropped(spark, path)
        path, n = after, rows.count()
        if n and not whole and 4 * n > 3 * before:
            return found, rows.select(*columns)
    dropped(spark, path)
    return found, None
