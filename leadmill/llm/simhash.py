"""SimHash near-duplicates: pigeonring candidate keys, chain check, Hamming check, components.

A fingerprint has 64 bits: each is set where more than half of the text's word shingles have it set in their
XXH64 (seed 42).  Copies share a fingerprint, so all that follows works on distinct fingerprints.

Pigeonring: cut the 64 bits into a ring of 16 segments of 4.  If two fingerprints differ in at most t bits, then
from some segment on, every chain of k consecutive segments differs in at most floor(k*t/16) bits.  For t = 3 a
chain's first 5 segments agree (20 bits) and its first 10 differ in one bit at most, so one half of the next 20
bits agrees as well: 30 bits, at one of 16 starts, in one of two halves.  These 32 masks are the join keys; they
miss no pair, and unrelated fingerprints meet once in 2**30.

A key's fingerprints are never paired in Spark rows.  Keys with two are a pair as they stand (their least and
greatest).  Those with up to BLOCK are one array: a task tests chains and Hamming distances in numpy and returns a
spanning forest of the links, which keeps every component whole without emitting all its pairs.  The fingerprints of a larger key
get new keys: of the bits that the key leaves open, cut into t + 1 parts, a pair within t bits has one part equal, so it meets
again under one of t + 1 longer masks.  A round multiplies the rows of crowded keys by t + 1, however many share a key, and after ROUNDS rounds so few bits are
open that a key's fingerprints are bounded (`most_under`); those are dealt into blocks, and every pair of blocks is one array.

Defined results: null and empty texts have fingerprint zero and are linked like any other; fewer words than a
shingle count as one shingle; a null doc_id is kept and never chosen as a component's id unless all are null;
repeated rows stay repeated; an empty table gives no rows; other columns are not read.  Texts are read whole, in pieces of
bounded memory.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, local_table, union_all, written

BITS, SEGMENTS = 64, 16
WIDTH = BITS // SEGMENTS
FULL = (1 << BITS) - 1
#: Fingerprints of a key that are compared in one array; an array of two blocks holds about twice as many.
BLOCK = 256
#: Rounds of longer masks for crowded keys.
ROUNDS = 4
#: Shingles whose bits are counted at a time.
PIECE = 1 << 16


def fingerprint(text: str | None, words: int = 3) -> int:
    s = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
    if not s:
        return 0
    blanks = np.flatnonzero(np.frombuffer(s, np.uint8) == 32)
    starts, ends = np.append(0, blanks + 1), np.append(blanks, len(s))
    if len(starts) <= words:
        return xxhash.xxh64_intdigest(s, 42)
    of, counts, n = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(starts) - words + 1
    for at in range(0, n, PIECE):
        last = min(at + PIECE, n)
        h = np.array([of(s[a:b], 42) for a, b in zip(starts[at:last].tolist(), ends[at + words - 1 : last + words - 1].tolist(), strict=True)], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp): fp holds the 64 bits as a signed long."""

    def each(batches):
        for b in batches:
            fp = np.array([fingerprint(x.as_py(), words) for x in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(each, "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def ring_masks() -> list[int]:
    """The 32 masks that any two fingerprints within 3 bits agree under at least once."""
    arc = lambda start, n: sum(1 << ((start + k) % BITS) for k in range(n))
    return [_signed(arc(s, 20) | arc(s + 20 + half, 10)) for s in range(0, BITS, WIDTH) for half in (0, 10)]


def longer_masks(mask: int, most: int) -> list[int]:
    """mask with each of most + 1 parts of the bits that it leaves open: a pair within `most` bits that agrees under mask agrees under one of these."""
    open_ = [b for b in range(BITS) if not mask >> b & 1]
    parts = [open_[k * len(open_) // (most + 1) : (k + 1) * len(open_) // (most + 1)] for k in range(most + 1)]
    return [_signed((mask | sum(1 << b for b in part)) & FULL) for part in parts if part]


def most_under(most: int) -> int:
    """How many distinct fingerprints a key of the last round can have: those of its open bits."""
    open_ = BITS - 30
    for _ in range(ROUNDS):
        open_ -= open_ // (most + 1)
    return 1 << open_


def chained(x: np.ndarray, most: int) -> np.ndarray:
    """Of XORs of fingerprints: those with a start from which every chain keeps its proportional budget."""
    part = np.stack([np.bitwise_count(x >> np.uint64(WIDTH * k) & np.uint64((1 << WIDTH) - 1)) for k in range(SEGMENTS)], axis=-1).astype(np.int16)
    sums = np.zeros_like(part)
    alive = np.ones(part.shape, bool)
    for n in range(1, SEGMENTS + 1):
        sums += np.roll(part, 1 - n, axis=-1)
        alive &= sums <= n * most // SEGMENTS
    return alive.any(axis=-1)


def forest(fp: np.ndarray, root: np.ndarray, most: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among some fingerprints, but for what their roots already join."""
    _, root = np.unique(root, return_inverse=True)
    edges = []
    for i in range(len(fp) - 1):
        rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
        x = fp[rest] ^ fp[i]
        if len(x):
            near = np.bitwise_count(x >> np.uint64(32)) <= most  # a bound on half the bits thins out before the chains
            rest, x = rest[near], x[near]
            ok = chained(x, most)
            rest, x = rest[ok], x[ok]
        for j in rest[np.bitwise_count(x) <= most]:
            if root[i] != root[j]:
                edges.append((int(fp[i].view(np.int64)), int(fp[j].view(np.int64))))
                root[root == root[j]] = root[i]
    return edges


def met_under(rooted: DataFrame, most: int, masks: list[int]) -> tuple[DataFrame, DataFrame]:
    """Of distinct fingerprints (fp, root): pairs (u, v), and arrays (fps, roots), that hold every pair of different roots within `most` bits.

    Keys whose fingerprints all have one root are left out by their least and greatest root.
    """
    spark = rooted.sparkSession
    keyed = lambda rows, under: rows.withColumn("key", F.xxhash64(under, F.col("fp").bitwiseAND(F.col("mask"))))
    keys = keyed(rooted.select("fp", "root", F.explode(F.lit(masks)).alias("mask")), "mask")
    twos, pools = [], []
    for level in range(ROUNDS + 1):
        met = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"), F.min("root").alias("r"), F.max("root").alias("s")).where("r < s")
        met = written(met.select("key", "n", "u", "v"), "met")
        twos.append(met.where("n = 2").select("u", "v"))
        few = keys.join(met.where(f"n > 2 and n <= {BLOCK}").select("key"), "key")
        pools.append(few.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("fp", "root"))).alias("p")))
        if not met.where(f"n > {BLOCK}").limit(1).count():
            break
        crowd = keys.join(met.where(f"n > {BLOCK}").select("key", "n"), "key")
        if level == ROUNDS:
            pools.append(_block_pairs(crowd))
            break
        table = [(m, longer_masks(m & FULL, most)) for m in masks]  # masks grow by most + 1 a round: a small table
        masks = sorted({x for _, more in table for x in more})
        longer = local_table(spark, {"mask": pa.array([m for m, _ in table], pa.int64()), "longer": pa.array([x for _, x in table], pa.list_(pa.int64()))})
        crowd = crowd.join(F.broadcast(longer), "mask").select("fp", "root", F.col("key").alias("under"), F.explode("longer").alias("mask"))
        # What agrees under a key and a longer mask of it is one group, whatever other masks lead to the same bits.
        keys = written(keyed(crowd, F.xxhash64("under", "mask")).drop("under"), "longer")
    return union_all(twos).distinct(), union_all([p.select(F.col("p.fp").alias("fps"), F.col("p.root").alias("roots")) for p in pools])


def links(rooted: DataFrame, most: int, masks: list[int]) -> DataFrame:
    """(u, v): of distinct fingerprints (fp, root), links between different roots that keep every component whole."""
    two, pools = met_under(rooted, most, masks)

    def linked(batches):
        for batch in batches:
            u, v = [], []
            for x, r in zip(batch.column(0), batch.column(1), strict=True):
                for a, b in forest(np.array(x.values, np.int64).view(np.uint64), np.array(r.values, np.int64), most):
                    u.append(a)
                    v.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def paired(batches):
        for batch in batches:
            u, v = (np.array(batch.column(k), np.int64) for k in (0, 1))
            x = (u ^ v).view(np.uint64)
            ok = chained(x, most)
            ok[ok] = np.bitwise_count(x[ok]) <= most
            yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], ["u", "v"])

    return two.mapInArrow(paired, "u long, v long").unionByName(pools.mapInArrow(linked, "u long, v long")).distinct()


def _block_pairs(crowd: DataFrame) -> DataFrame:
    """Of (key, n, fp, root): an array for every pair of blocks of a key."""
    crowd = crowd.withColumn("blocks", F.ceil(F.col("n") / BLOCK)).withColumn("b", F.pmod(F.xxhash64("fp", F.lit(1)), "blocks"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != F.col("b"))
    crowd = crowd.select("key", "fp", "root", "b", F.explode(others).alias("j"))
    return crowd.groupBy("key", F.least("b", "j").alias("i"), F.greatest("b", "j").alias("j")).agg(F.array_sort(F.collect_list(F.struct("fp", "root"))).alias("p"))


def near_duplicates(docs: DataFrame, words: int = 3, most: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id that links of at most `most` bits reach; most <= 3, for which the ring masks
    find every link."""
    if most > 3:
        raise ValueError("the ring masks find links of up to 3 bits")
    marked = written(fingerprints(docs, words), "fingerprints")
    # Tables that joins meet again are written: a join right above a grouping can't have its hot keys split.
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    found = links(distinct.select("fp", F.col("fp").alias("root")), most, ring_masks())
    roots = components(found)
    linked = written(distinct.join(roots.withColumnRenamed("node", "fp"), "fp"), "linked")  # most fingerprints have no link
    ids = written(linked.groupBy("root").agg(F.min("least").alias("joint")), "joint")
    joint = linked.join(ids, "root").select("fp", "joint")
    by_fp = written(distinct.join(joint, "fp", "left").select("fp", F.coalesce("joint", "least").alias("component_id")), "placed")
    return marked.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def digests(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
