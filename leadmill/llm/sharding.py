"""Histogram sort: exact byte counts below candidate boundaries, refined until the splitters meet a tolerance.

Rows are ordered by a 64-bit key: 24 bits of the text's hash, 24 bits of a hash of doc_id and text, and 16 bits that
tell rows apart which are equal in both.  So equal texts lie together, and yet any large group can be cut, be it of
equal texts or of repeated rows.  A pass counts bytes and rows between candidate boundaries; the first probes 2**STEP
even ones.  Only cells that hold a splitter's target are probed again, 2**STEP times finer, until every cell is within
the tolerance: at most LEVELS * shards * 2**STEP counts reach the driver, whatever the bytes.  Then every row goes to
its cell in one exchange, where it gets its place.  A cell of more than CELL_BYTES is sorted in parts, by more bits of
the key; parts that are still larger, as equal texts share their first bits, get FINER more in passes over their rows alone, until
no part but a single row, or rows of one whole key, is larger.  The counts of parts are summed on Spark and stay there.

Defined results: null texts and null doc_ids are values like any other (size 8 bytes for a null or empty text); rows
equal in doc_id and text may lie in different shards; texts of any length count their bytes and move as they are; ties
of the key are ordered by doc_id and text; an empty table gives no rows; existing columns named shard or slot are
replaced, any others stay.  No Python runs on the executors.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import local_table, union_all, written

#: Bits of the key that a pass adds.
STEP = 10
#: A cell that holds a splitter may hold this part of a shard's bytes; splitters lie at cell boundaries.
TOLERANCE = 1 / 512
#: Levels of probes: the last one has the whole key.
LEVELS = -(-64 // STEP)
#: Bytes that are sorted in one task: larger cells are placed in parts.
CELL_BYTES = 64 << 20
#: Bits by which a part that is too large is cut further.
FINER = 8


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8


def sort_key(doc_id: Column, text: Column) -> Column:
    """To be written once: the last bits come from a row's place in the table, as nothing else tells repeated rows apart."""
    high = F.shiftleft(F.shiftright(F.xxhash64(text), 40), 40)
    middle = F.shiftleft(F.shiftrightunsigned(F.xxhash64(doc_id, text), 40), 16)
    return high.bitwiseOR(middle).bitwiseOR(F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 48))


def _bits(level: int) -> int:
    return min(64, level * STEP)


def _prefix(key: Column, level: int) -> Column:
    return F.shiftrightunsigned(key, 64 - _bits(level))


def _start(prefix: Column, level: int) -> Column:
    """Where a cell starts, with the sign bit flipped, so that longs order like the unsigned keys."""
    return F.shiftleft(prefix, 64 - _bits(level)).bitwiseXOR(F.lit(-(1 << 63)))


def cell_of(key: Column, cut: dict[int, list[int]]) -> Column:
    """The start of the row's cell: that of the first level whose prefix was not cut further."""
    deepest = max(cut, default=0) + 1
    found = _start(_prefix(key, deepest), deepest)
    for level in range(deepest - 1, 0, -1):
        if cut.get(level):
            found = F.when(_prefix(key, level).isin(cut[level]), found).otherwise(_start(_prefix(key, level), level))
    return found


@dataclass
class Plan:
    """cut: the prefixes probed further, by level.  cells: (cell, bits, shard, first_slot); the first bits of a row's key are its part of its cell.
    splits: (part, more) of parts that are cut by more bits, pass by pass.  parts: (cell, part, before) or None."""

    cut: dict[int, list[int]]
    cells: DataFrame
    splits: list[DataFrame]
    parts: DataFrame | None
    counted: int

    def located(self, keyed: DataFrame) -> DataFrame:
        """keyed with cell, part, bits, shard and first_slot; a part is known by where it starts."""
        rows = keyed.withColumn("cell", cell_of(F.col("key"), self.cut)).join(F.broadcast(self.cells), "cell").withColumn("part", _part())
        for split in self.splits:
            rows = rows.join(split, "part", "left").withColumn("bits", F.coalesce("more", "bits")).drop("more").withColumn("part", _part())
        return rows


def _part() -> Column:
    return F.expr("shiftleft(shiftrightunsigned(key, 64 - bits), 64 - bits)").bitwiseXOR(F.lit(-(1 << 63)))


def planned(keyed: DataFrame, shards: int) -> Plan:
    """The shards of (key, size).  Every pass is one aggregation, combined before its shuffle, over the cells that are probed again."""
    cut: dict[int, list[int]] = {}
    cells: dict[int, tuple[int, int, int]] = {}  # start -> level, bytes, rows
    counted = 0
    for level in range(1, LEVELS + 1):
        rows = keyed if level == 1 else keyed.where(_prefix(F.col("key"), level - 1).isin(cut[level - 1]))
        found = rows.groupBy(_prefix(F.col("key"), level).alias("p")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        for r in found.select(_start(F.col("p"), level).alias("start"), "bytes", "rows").collect():  # 2**STEP rows for each cell that is probed: fewer than `shards` cells
            cells[r.start] = (level, r.bytes, r.rows)
            counted += 1
        total, starts = sum(c[1] for c in cells.values()), sorted(cells)
        ends = list(accumulate(cells[s][1] for s in starts))
        targets = [total * k / shards for k in range(1, shards)]
        held = {starts[min(bisect_left(ends, t), len(starts) - 1)] for t in targets} if starts else set()
        again = [s for s in held if cells[s][0] == level < LEVELS and cells[s][2] > 1 and cells[s][1] > TOLERANCE * total / shards]
        if not again:
            break
        cut[level] = [((s ^ -(1 << 63)) & (1 << 64) - 1) >> (64 - _bits(level)) for s in again]
        for s in again:
            del cells[s]
    edges = [0, *ends] if cells else [0]
    marks = [min((i for i in (bisect_left(edges, t) - 1, bisect_left(edges, t)) if 0 <= i < len(edges)), key=lambda i: abs(edges[i] - t)) for t in targets]
    shard, first, slot, of, at = 0, [], 0, [], iter([*marks, len(starts) + 1])
    mark = next(at)
    for i, s in enumerate(starts):
        while mark <= i:
            shard, slot, mark = shard + 1, 0, next(at)
        of.append(shard)
        first.append(slot)
        slot += cells[s][2]
    bits = [min(64, _bits(cells[s][0]) + (2 * cells[s][1] // CELL_BYTES).bit_length() * (cells[s][1] > CELL_BYTES)) for s in starts]
    table = local_table(keyed.sparkSession, {"cell": pa.array(starts, pa.int64()), "bits": pa.array(bits, pa.int32()), "shard": pa.array(of, pa.int32()), "first_slot": pa.array(first, pa.int64())})
    plan = Plan(cut, table, [], None, counted)
    if any(b > _bits(cells[s][0]) for s, b in zip(starts, bits, strict=True)):
        before = F.coalesce(F.sum("rows").over(Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        plan.parts = written(parted(keyed, plan).select("cell", "part", before.alias("before")), "places")
    return plan


def parted(keyed: DataFrame, plan: Plan) -> DataFrame:
    """(cell, part, bits, rows, bytes) of all parts, none of them above CELL_BYTES that can be cut; adds to plan.splits what is cut."""
    by = lambda rows: rows.groupBy("cell", "part").agg(F.max("bits").alias("bits"), F.count("*").alias("rows"), F.sum("size").alias("bytes"))
    found, done = written(by(plan.located(keyed)), "parts"), []
    while True:
        big = (F.col("bytes") > CELL_BYTES) & (F.col("rows") > 1) & (F.col("bits") < 64)
        if not found.where(big).limit(1).count():
            return union_all([*done, found])
        done.append(found.where(~big))
        split = written(found.where(big).select("part", F.least(F.col("bits") + FINER, F.lit(64)).alias("more")), "splits")
        rows = plan.located(keyed).join(split, "part").withColumn("bits", F.col("more")).withColumn("part", _part())
        found = written(by(rows), "parts")
        plan.splits.append(split)


def placed(keyed: DataFrame, plan: Plan, order: list[str]) -> DataFrame:
    """keyed with shard and slot, slots counted from 0 in each shard.  The one exchange deals rows to cells and their parts."""
    rows = plan.located(keyed)
    rows = rows.withColumn("before", F.lit(0)) if plan.parts is None else rows.join(plan.parts, ["cell", "part"])
    within = Window.partitionBy("cell", "part").orderBy("key", *order)
    return rows.withColumn("slot", F.col("first_slot") + F.col("before") + F.row_number().over(within) - 1).drop("cell", "part", "bits", "before", "first_slot", "key")


def digests(docs: DataFrame, shards: int = 24) -> DataFrame:
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    narrow = written(docs.select("doc_id", text_bytes(F.col("text")).alias("size"), crc.alias("text_crc32"), sort_key(F.col("doc_id"), F.col("text")).alias("key")), "sizes")
    return placed(narrow, planned(narrow, shards), ["doc_id", "text_crc32"]).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = 24) -> DataFrame:
    """The rows of docs with shard and slot.  They are written with their keys once, as the passes and the exchange must see the same keys."""
    kept = [c for c in docs.columns if c not in ("shard", "slot")]
    whole = written(docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), text_bytes(F.col("text")).alias("size"), sort_key(F.col("doc_id"), F.col("text")).alias("key")), "keyed")
    plan = planned(whole.select("key", "size"), shards)
    return placed(whole.select("row", "key"), plan, ["row.doc_id", "row.text"]).select("row.*", "shard", "slot")
