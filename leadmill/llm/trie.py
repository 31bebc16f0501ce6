"""Prefix tries of conversations, by radix partitioning of dictionary-encoded turns.

Distinct turns (role, text) get numbers from a written dictionary, so a conversation is an array of numbers.  Equal arrays are one
sequence with a count, its smallest conv_id and the hash of all its conv_ids; from here on a crowd of copies is one row.

The sequences are then partitioned by their most significant digit, the next turn.  A bucket is all sequences under one branching
node; its least and greatest sequence show how far all of them agree, and that chain is emitted at once.  The turn after it
deals the bucket into smaller ones; those of more than LOCAL sequences, or LOCAL_TURNS turns, go through another round, so rounds
grow with the depth of branching in crowded buckets, not with the length of conversations.  The others are finished inside a task: multikey
quicksort splits a bucket at a digit into less, equal and greater, and every equal part is a node.  Sums over subtrees come up from
the tasks and round by round to the root.

Turns that only one sequence has are cut off by segments of SEGMENT turns, and emitted as rows of their own: a conversation may hold any part of
all rows, and an array holds no more than what it shares with others, and a segment.

Defined results: turns are ordered by number (null first), then role and text; null roles and texts are empty; repeated rows are turns
like any other; rows with a null conv_id belong to no conversation; texts of any length are read whole, and stand for themselves by SHA-256; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .chat import LONG, numbered
from .common import union_all, written

#: Sequences, and turns in them, of a bucket that a task finishes.
LOCAL, LOCAL_TURNS = 1024, 1 << 16
SEGMENT = 1024
#: conv_ids that are joined to one string at a time.
CHUNK = 4096
#: Turns of the first conversation of five that another may open with: crc32 modulo this.
HEADS, FAMILY = 9, 5
NO_ENDS = hashlib.sha256(b"").hexdigest()
LONGS = "array<long>"
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
NODES = [c.split(" ")[0] for c in NODE.split(", ")]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, turn, bytes), written: the place of a turn in its conversation from 1, its number in the dictionary, and its text's size."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    said = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    if rows.groupBy("conv_id").count().where(F.col("count") > LONG).limit(1).count():
        parts = numbered(rows, ["conv_id"])
    else:
        parts = [rows.withColumn("at", F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long"))]
    placed = written(union_all([x.select("conv_id", "at", said.alias("said"), F.octet_length("text").cast("long").alias("bytes")) for x in parts]), "placed")
    # Written, so numbers are given once; the dictionary has no grouping above it, so a hot turn can be split in the join.
    words = written(placed.groupBy("said").agg(F.count("*").alias("k")).select("said", F.monotonically_increasing_id().alias("turn")), "dictionary")
    return written(placed.join(words, "said").select("conv_id", "at", "turn", "bytes"), "turns")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id), and their turns after rebuilding.

    Conversation c opens with the first h turns of the first of its family, c - c % 5 (with SQL's remainder, of c's sign), and goes on with its own after the first h;
    h is crc32(c) modulo 9.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS))
    own = rows.groupBy("conv_id").agg(F.max("at").alias("n"))
    has = own.select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")).join(own.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base")), "base", "left")
    has = written(has.select("conv_id", "h", "base", F.least("h", F.coalesce("n_base", F.lit(0))).alias("opening")), "openings")
    heads = rows.where(F.col("at") < HEADS).withColumnRenamed("conv_id", "base").join(has, "base").where("at <= opening").select("conv_id", "at", "turn", "bytes")
    rest = rows.join(has, "conv_id").where("at > h").select("conv_id", (F.col("at") - F.col("h") + F.col("opening")).alias("at"), "turn", "bytes")
    return has.select("conv_id"), heads.unionByName(rest)


def _digest(c: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(c, ","), 256))


def ends(members: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """(key, ends): SHA-256 of each key's conv_ids in order, comma-joined; sizes (key, w) are written, most is the largest w.

    Large groups are sorted in ranges and joined to strings of at most CHUNK numbers, which one task hashes as they come.
    """
    rows = members if most <= CHUNK else members.join(sizes.select("key", "w"), "key")
    few = rows if most <= CHUNK else rows.where(F.col("w") <= CHUNK)
    few = few.groupBy("key").agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("s")).select("key", F.sha2("s", 256).alias("ends"))
    if most <= CHUNK:
        return few
    many = rows.where(F.col("w") > CHUNK).repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").select("key", "conv_id")

    def joined(batches):
        key, first, held = None, None, []
        for b in batches:
            for k, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if held and (k != key or len(held) >= CHUNK):
                    yield pa.RecordBatch.from_pydict({"key": [key], "first": [first], "s": [",".join(held)]})
                    held = []
                if not held:
                    key, first = k, c
                held.append(str(c))
        if held:
            yield pa.RecordBatch.from_pydict({"key": [key], "first": [first], "s": [",".join(held)]})

    def hashed(batches):
        key, h = None, None
        for b in batches:
            for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if k != key:
                    if h:
                        yield pa.RecordBatch.from_pydict({"key": [key], "ends": [h.hexdigest()]})
                    key, h = k, hashlib.sha256(s.encode())
                else:
                    h.update(b"," + s.encode())
        if h:
            yield pa.RecordBatch.from_pydict({"key": [key], "ends": [h.hexdigest()]})

    parts = written(many.mapInArrow(joined, "key binary, first long, s string"), "chunks")
    return few.unionByName(parts.repartition("key").sortWithinPartitions("key", "first").select("key", "s").mapInArrow(hashed, "key binary, ends string"))


def sequences(convs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Distinct sequences: (ids, lens, w, low, ends, tail, tail_saved), written, and the nodes of their tails, if there are any.

    ids are the turns up to the end of the first segment that no other sequence shares, lens their bytes, w the conversations that have the
    sequence, low the smallest of them; tail says that turns were cut off, and tail_saved what those save.
    """
    part = F.array_sort(F.collect_list(F.struct("at", "turn", "bytes")))
    parts = rows.groupBy("conv_id", F.floor((F.col("at") - 1) / SEGMENT).alias("seg")).agg(part.alias("p"))
    parts = written(parts.select("conv_id", "seg", F.col("p.turn").alias("ids"), F.col("p.bytes").alias("lens")), "segments")
    digests = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("seg", _digest("ids").alias("d")))).alias("c")).select("conv_id", F.col("c.d").alias("chain"))
    members = convs.join(digests, "conv_id", "left").withColumn("chain", F.coalesce("chain", F.array().cast("array<binary>")))
    members = members.select("conv_id", "chain", F.unhex(F.sha2(F.array_join(F.transform("chain", F.hex), ","), 256)).alias("key"))
    members = written(members, "members")
    found = written(members.groupBy("key").agg(F.count("*").alias("w"), F.min("conv_id").alias("low"), F.max("chain").alias("chain")), "sequences")
    most, segments = found.agg(F.coalesce(F.max("w"), F.lit(0)), F.coalesce(F.max(F.size("chain")), F.lit(0))).first()
    ended = ends(members.select("key", "conv_id"), found, most)
    if segments <= 1:  # no tails
        none = F.array().cast(LONGS)
        arrays = found.join(ended, "key").join(parts.withColumnRenamed("conv_id", "low"), "low", "left")
        out = arrays.select(F.coalesce("ids", none).alias("ids"), F.coalesce("lens", none).alias("lens"), "w", "low", "ends", F.lit(False).alias("tail"), F.lit(0).cast("long").alias("tail_saved"))
        return written(out, "arrays"), None
    # Sequences of several segments keep those that start as another one does, and the next.
    live = found.where(F.size("chain") > 1).select("key", "chain", F.col("chain")[0].alias("prefix"))
    single = found.where(F.size("chain") == 1).select("key", "chain", F.col("chain")[0].alias("prefix"))
    cuts, s = [found.where(F.size("chain") <= 1).select("key", F.lit(1).alias("keep"))], 1
    while live.limit(1).count():
        all_ = live if s > 1 else live.unionByName(single)
        shared = written(all_.groupBy("prefix").agg(F.count("*").alias("k")).where("k > 1").select("prefix"), "shared")
        on = live.join(shared.withColumn("more", F.lit(True)), "prefix", "left")
        cuts.append(on.where(F.col("more").isNull() | (F.size("chain") == s)).select("key", F.lit(s).alias("keep")))
        live = written(on.where(F.col("more") & (F.size("chain") > s)).select("key", "chain", F.unhex(F.sha2(F.concat("prefix", F.col("chain")[s]), 256)).alias("prefix")), "live")
        s += 1
    found = written(found.join(union_all(cuts), "key").join(ended, "key"), "ended")
    mine = parts.join(found.select(F.col("low").alias("conv_id"), "w", "keep", "ends"), "conv_id")
    cut = written(mine.where("seg >= keep"), "tails")
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    # A tail's turns save what the copies after the first save, from each turn to the end.
    later = F.coalesce(F.sum("bytes").over(W.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = written(cut.select("conv_id", "seg", total("lens").alias("bytes")).withColumns({"later": later, "last": F.max("seg").over(W.partitionBy("conv_id"))}), "later")
    tail = cut.join(sums, ["conv_id", "seg"]).select("*", F.posexplode("lens").alias("k", "len"))
    rest = F.sum("len").over(W.partitionBy("conv_id", "seg").orderBy(F.desc("k")))
    end = (F.col("seg") == F.col("last")) & (F.col("k") == F.size("lens") - 1)
    tail = tail.withColumn("saved", (F.col("w") - 1) * (F.col("later") + rest))
    nodes = tail.select(
        "conv_id", (F.col("seg") * SEGMENT + F.col("k") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("w").alias("n_convs"),
        F.when(end, 0).otherwise(1).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.when(end, F.col("ends")).otherwise(NO_ENDS).alias("ends_sha256"),
    )
    kept = F.array_sort(F.collect_list(F.when(F.col("seg") < F.col("keep"), F.struct("seg", "ids", "lens")))).alias("p")
    arrays = written(mine.groupBy("conv_id").agg(kept), "arrays").withColumnRenamed("conv_id", "low")
    tails = sums.groupBy("conv_id").agg(F.sum("bytes").alias("tail_bytes")).withColumnRenamed("conv_id", "low")
    flat = lambda c: F.coalesce(F.flatten(F.col(f"p.{c}")), F.array().cast(LONGS))
    out = found.join(arrays, "low", "left").join(tails, "low", "left")
    out = out.select(flat("ids").alias("ids"), flat("lens").alias("lens"), "w", "low", "ends", F.col("tail_bytes").isNotNull().alias("tail"), (F.coalesce("tail_bytes", F.lit(0)) * (F.col("w") - 1)).alias("tail_saved"))
    return written(out, "arrays"), nodes


def dealt(rows: DataFrame, by: list[str]) -> DataFrame:
    """A row for every bucket of rows: its sequences, conversations, smallest one, and how far all of them agree."""
    got = rows.groupBy(*by).agg(F.count("*").alias("k"), F.sum("w").alias("w"), F.min("low").alias("low"), F.min("ids").alias("lo"), F.max("ids").alias("hi"), F.any_value("lens").alias("lens"), F.sum(F.size("ids")).alias("turns"), F.any_value("ends").alias("ends"), F.any_value("tail").alias("tail"), F.any_value("tail_saved").alias("tail_saved"))
    same = F.transform(F.zip_with("lo", "hi", lambda a, b: a == b), lambda x: F.coalesce(x, F.lit(False)))
    differs = F.array_position(same, False)
    return got.withColumn("upto", F.when(differs == 0, F.size("lo")).otherwise(differs - 1).cast("long")).drop("lo", "hi")


def quicksorted(bucket: list[tuple], depth: int, out: list[list], parent: int) -> None:
    """Nodes of some sequences (ids, lens, w, low, ends, tail, tail_saved) that agree up to depth, appended to out before their children:
    [conv_id, depth, place of the parent in out, n_convs, n_children, n_leaves, saved, ends, bytes]."""
    todo = [(bucket, depth, parent)]
    while todo:
        rows, depth, parent = todo.pop()
        if len(rows) == 1:  # a chain to its end
            ids, lens, w, low, end, tail, tail_saved = rows[0]
            for d in range(depth, len(ids)):
                last = d + 1 == len(ids)
                if parent >= 0:
                    out[parent][4] += 1
                out.append([low, d + 1, parent, w, int(last and tail), int(last and tail), tail_saved if last and tail else 0, end if last and not tail else NO_ENDS, lens[d]])
                parent = len(out) - 1
            continue
        pivot = rows[len(rows) // 2][0][depth]
        less, equal, more = [], [], []
        for r in rows:
            digit = r[0][depth]
            (equal if digit == pivot else less if digit < pivot else more).append(r)
        for part in (less, more):
            if part:
                todo.append((part, depth, parent))
        if parent >= 0:
            out[parent][4] += 1
        node = [min(r[3] for r in equal), depth + 1, parent, sum(r[2] for r in equal), 0, 0, 0, NO_ENDS, equal[0][1][depth]]
        out.append(node)
        ended = [r for r in equal if len(r[0]) == depth + 1]
        for _, _, _, _, end, tail, tail_saved in ended:  # one at most
            if tail:
                node[4:7] = [1, 1, tail_saved]
            else:
                node[7] = end
        going = [r for r in equal if len(r[0]) > depth + 1]
        if going:
            todo.append((going, depth + 1, len(out) - 1))


def finished(local: DataFrame) -> DataFrame:
    """The nodes of local buckets, in columns NODE, and p_low and p_depth, the parent, where the node is a bucket's first."""
    fields = ["p_low", "p_depth", "next", "ids", "lens", "w", "low", "ends", "tail", "tail_saved"]
    schema = pa.schema([(c, pa.string() if c == "ends_sha256" else pa.int64()) for c in [*NODES, "p_low", "p_depth"]])

    def nodes(key, bucket):
        p_low, p_depth, _ = key
        out: list[list] = []
        quicksorted(bucket, p_depth, out, -1)
        for n in reversed(out):
            n[5] = n[5] or (0 if n[4] else 1)
            n[6] += (n[3] - 1) * n[8]
            if n[2] >= 0:
                up = out[n[2]]
                up[5] += n[5]
                up[6] += n[6]
        return [(n[0], n[1], out[n[2]][0] if n[2] >= 0 else p_low, n[3], n[4], n[5], n[6], n[7], *((p_low, p_depth) if n[2] < 0 else (None, None))) for n in out]

    def each(batches):
        key, bucket, done = None, [], []
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[:3] != key:
                    if bucket:
                        done += nodes(key, bucket)
                    key, bucket = r[:3], []
                    if len(done) >= 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)
                        done = []
                bucket.append(r[3:])
        if bucket:
            done += nodes(key, bucket)
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)

    by = ["p_low", "p_depth", "next"]
    return local.select(*fields).repartition(*by).sortWithinPartitions(*by).mapInArrow(each, f"{NODE}, p_low long, p_depth long")


def trie(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """A row for every distinct sequence of first turns of (conv_id, at, turn, bytes), in columns NODE; convs has every conversation, turnless ones too."""
    seqs, nodes = sequences(convs, rows)
    # The root is a bucket of its own, whatever its size: its turns deal it out.
    big = dealt(seqs.withColumns({"p_low": F.lit(None).cast("long"), "p_depth": F.lit(-1).cast("long"), "next": F.lit(0).cast("long")}), ["p_low", "p_depth", "next"])
    big = written(big.drop("next"), "root")
    root = big.select("low", "upto").first()  # one row, none of an empty table
    levels, locals_ = [], []
    rows = seqs.withColumns({"p_low": F.lit(root and root.low).cast("long"), "p_depth": F.lit(root.upto if root else 0).cast("long")})
    while True:
        rows = rows.withColumn("next", F.get("ids", F.col("p_depth").cast("int")))
        by = ["p_low", "p_depth", "next"]
        kids = written(dealt(rows, by), "buckets")
        levels.append((big, kids))
        kids = kids.where("next is not null")
        is_big = (F.col("k") > 1) & ((F.col("k") > LOCAL) | (F.col("turns") - F.col("k") * F.col("p_depth") > LOCAL_TURNS))
        crowded = kids.where(is_big)
        here = written(rows.where("next is not null").join(kids.select(*by, is_big.alias("big"), F.col("low").alias("k_low"), "upto"), by), "dealt")
        locals_.append(here.where("not big"))
        if not crowded.limit(1).count():
            break
        big = crowded.select("p_low", "p_depth", "k", "w", "low", "lens", "ends", "tail", "tail_saved", "upto")
        rows = here.where("big").select("ids", "lens", "w", "low", "ends", "tail", "tail_saved", F.col("k_low").alias("p_low"), F.col("upto").alias("p_depth"))
    local = written(finished(union_all([x.drop("big", "k_low", "upto") for x in locals_])), "nodes")
    tops = local.where("p_depth is not null").groupBy("p_low", "p_depth").agg(F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.count("*").alias("children"))
    inner = []
    for big, kids in reversed(levels):
        # A sequence that ends at the branching node: its conversations end there, or go on as its tail.
        end = kids.where("next is null").select(F.col("p_low").alias("low"), F.col("p_depth").alias("upto"), F.col("ends").alias("end"), F.col("tail").alias("goes_on"), F.col("tail_saved").alias("end_saved"))
        sums = tops.groupBy("p_low", "p_depth").agg(*[F.sum(c).alias(c) for c in ("leaves", "saved", "children")]).withColumnsRenamed({"p_low": "low", "p_depth": "upto"})
        zero = lambda c: F.coalesce(c, F.lit(0))
        on = F.coalesce("goes_on", F.lit(False)).cast("long")
        at = big.select("p_low", "p_depth", "low", "upto", "w", "lens").join(sums, ["low", "upto"], "left").join(end, ["low", "upto"], "left")
        at = at.select("p_low", "p_depth", "low", "upto", "w", "lens", (zero("children") + on).alias("children"), (zero("leaves") + on).alias("leaves"), (zero("saved") + zero("end_saved")).alias("saved"), F.when(on == 1, NO_ENDS).otherwise(F.coalesce("end", F.lit(NO_ENDS))).alias("end"))
        at = at.withColumn("leaves", F.greatest("leaves", F.lit(1)))
        # The chain from below the parent to the branching node.
        chain = at.withColumn("depth", F.explode(F.sequence(F.col("p_depth") + 1, F.col("upto"))))
        own = F.when(F.col("depth") > 0, F.get("lens", (F.col("depth") - 1).cast("int"))).otherwise(0) * (F.col("w") - 1)
        below = F.sum(own).over(W.partitionBy("low", "upto").orderBy(F.desc("depth")))
        last = F.col("depth") == F.col("upto")
        chain = chain.withColumn("saved_tokens", F.col("saved") + below)
        chain = chain.select(
            F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("p_depth") + 1, F.col("p_low")).otherwise(F.col("low")).alias("parent_conv_id"), F.col("w").alias("n_convs"),
            F.when(last, F.col("children")).otherwise(1).alias("n_children"), F.col("leaves").alias("n_leaves"), "saved_tokens", F.when(last, F.col("end")).otherwise(NO_ENDS).alias("ends_sha256"), "p_low", "p_depth",
        )
        chain = written(chain, "chain")
        inner.append(chain.select(*NODES))
        top = chain.where("depth = p_depth + 1 and p_depth >= 0").select("p_low", "p_depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"), F.lit(1).cast("long").alias("children"))
        tops = tops.unionByName(top)
    return union_all([local.select(*NODES), *([nodes.select(*NODES)] if nodes else []), *inner])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they stand."""
    rows = turns(conversations)
    return trie(rows.select("conv_id").distinct(), rows)


def digests(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    convs, rows = rebuilt(turns(conversations))
    return trie(convs, rows)
