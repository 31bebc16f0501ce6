"""Near-duplicate texts: SimHash and MinHash keys propose pairs, exact Jaccard of five-word shingles confirms them.

Two texts are near-duplicates where the sets of their five-word shingles have a Jaccard similarity of 0.8 or more; one
document of every component stays.  Words are those of `simhash.fingerprint`; fewer words than a shingle are one shingle.

Keys: `simhash.links` finds the fingerprints within MOST bits (ring masks as keys, chain check, Hamming check), and texts of one
component of theirs share a key, so every pair within MOST bits does.  Pairs at 0.8 often differ in more
bits than masks can meet, so BANDS bands of ROWS MinHash values are keys as well: a pair at 0.8 shares none of
them with a chance of (1 - 0.8 ** ROWS) ** BANDS, below 1e-4, and closer pairs with less.

Confirmation, in two rounds: in the first, every text of a key is paired with the least one, linear in the texts of a
key, and the pairs are joined to the shingle sets.  In the second, texts of a key that the confirmed links have not
joined are dealt into blocks: first with their sketches, and texts without a partner that may
reach 0.8 drop out; then with their shingle sets, and a spanning forest of the links leaves each pair of blocks.  So a group
of copies that stay below 0.8 of each other never becomes a table of pairs.  Where sizes rule 0.8 out, or sketches agree in fewer than
SKETCH values (more than five standard deviations below 0.8), sets are not compared.  No two texts are joined but by
links that were confirmed.

Defined results: of a component stays the row with the least doc_id, null ones last, then the least text hash, so
reruns agree and rows with a repeated or null doc_id are told apart by their text; rows equal in both stay once; null
and empty texts and those of blanks alone are equal; texts of any length are read whole, hashed in pieces; other columns stay,
and an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import components, written
from .licenses import multipliers, shingles
from .simhash import BLOCK, fingerprint, ring_masks

WORDS, BANDS, ROWS, SKETCH = 5, 25, 5, 75
#: Bits in which the fingerprints of a SimHash link differ at most.
MOST = 3
#: Texts, and shingles, in a block whose sets are compared; a pair of blocks holds about twice as many.
POOL_TEXTS, POOL_SHINGLES = 512, 1 << 18
#: Shingles that are hashed for the sketch at a time.
PIECE = 512
DOC = ["__d", "__unnamed", "__t"]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def shingle_set(text: str | None, known: _Hashes) -> np.ndarray:
    """The distinct hashes of the text's five-word shingles."""
    own = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(known.__getitem__, own), np.uint64, len(own))
    size = min(WORDS, len(words))
    return np.unique(shingles(words, size)[: len(words) - size + 1])


def sketch(own: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The MinHash values of a set; an empty set has the greatest value everywhere.

    The members are hashes, so the upper half of each times an odd number is a random order; 32 bits keep a piece in the
    cache, and two sets whose least members only collide differ when they are confirmed.
    """
    least = np.full(len(factors), np.iinfo(np.uint32).max, np.uint32)
    x, odd = (own >> np.uint64(32)).astype(np.uint32), (factors >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    for at in range(0, len(x), PIECE):
        least = np.minimum(least, (x[at : at + PIECE, None] * odd).min(axis=0))
    return least.astype(np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    return shingles(np.append(np.arange(BANDS, dtype=np.uint64)[:, None], least.reshape(BANDS, ROWS), axis=1).ravel(), ROWS + 1)[:: ROWS + 1].view(np.int64)


def keyed(docs: DataFrame) -> DataFrame:
    """(row, text, DOC): every row of docs as a struct, whatever its columns are called, its text, and its key: number, whether it is null, text hash."""
    number, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, text.alias("text"), F.coalesce(number, F.lit(0)).alias("__d"), number.isNull().alias("__unnamed"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__t"))


def picked(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of docs (with DOC) for each row key."""
    return docs.join(keys, DOC, "left_semi").dropDuplicates(DOC)


def marked(docs: DataFrame) -> DataFrame:
    """DOC, fp, n, sketch (the low byte of every MinHash value) and bands of every row of docs."""

    def each(batches):
        known, factors = _Hashes(), multipliers(BANDS * ROWS)
        for b in batches:
            rows = []
            for x in b.column(3):
                text = x.as_py()
                own = shingle_set(text, known)
                least = sketch(own, factors)
                rows.append((np.uint64(fingerprint(text)).view(np.int64), len(own), least.astype(np.uint8).tobytes(), band_keys(least)))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())), strict=True))], [*DOC, "fp", "n", "sketch", "bands"])

    rows = docs.select(*DOC, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(each, "__d long, __unnamed boolean, __t long, fp long, n long, sketch binary, bands array<long>")


def sets(docs: DataFrame) -> DataFrame:
    """(__t, shingles) of every row of docs."""

    def each(batches):
        known = _Hashes()
        for b in batches:
            for part in (b.slice(at, 256) for at in range(0, b.num_rows, 256)):
                own = [shingle_set(x.as_py(), known).view(np.int64) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own, pa.list_(pa.int64()))], ["__t", "shingles"])

    return docs.select("__t", F.col("text").cast("string").alias("text")).mapInArrow(each, "__t long, shingles array<long>")


def sets_of(ends: DataFrame, heads: DataFrame, docs: DataFrame) -> DataFrame:
    """(__t, shingles) of the texts in ends, read from docs again and written."""
    return written(sets(picked(docs, written(heads.join(ends.distinct(), "__t", "left_semi").select(*DOC), "ends"))), "sets")


def alike(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """Of pairs (u, v), those whose sizes and sketches allow 0.8."""
    side = lambda c: heads.select(F.col("__t").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    rows = pairs.join(side("u"), "u").join(side("v"), "v").where("5 * least(n_u, n_v) >= 4 * greatest(n_u, n_v)").select("u", "v", "s_u", "s_v")

    def each(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(k).to_pylist()), np.uint8).reshape(b.num_rows, -1) for k in (2, 3))
            ok = pa.array((x == y).sum(axis=1) >= SKETCH, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(ok), b.column(1).filter(ok)], ["u", "v"])

    return rows.mapInArrow(each, "u long, v long")


def confirmed(pairs: DataFrame, heads: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) whose shingle sets have a Jaccard similarity of 0.8 or more."""
    pairs = written(alike(pairs, heads), "alike")
    own = sets_of(pairs.select(F.explode(F.array("u", "v")).alias("__t")), heads, docs)
    both = pairs.join(own.select(F.col("__t").alias("v"), F.col("shingles").alias("y")), "v").join(own.select(F.col("__t").alias("u"), F.col("shingles").alias("x")), "u")
    both = both.select("u", "v", (F.size("x") + F.size("y")).alias("sum"), F.size(F.array_intersect("x", "y")).alias("common"))
    return both.where("5 * common >= 4 * (sum - common)").select("u", "v")


def dealt(members: DataFrame, blocks, *columns: str) -> DataFrame:
    """(key, i, j): members of a key dealt into `blocks` blocks, and a row for every pair of blocks with arrays of the columns."""
    many = members.withColumn("blocks", blocks).withColumn("b", F.pmod(F.xxhash64("__t", F.lit(1)), "blocks"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: j != F.col("b")))
    many = many.select("key", *columns, "b", F.explode(others).alias("j"))
    pools = many.groupBy("key", F.least("b", "j").alias("i"), F.greatest("b", "j").alias("j")).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias("p"))
    return pools.select("key", *[F.col(f"p.{c}").alias(c) for c in columns])


def promising(members: DataFrame) -> DataFrame:
    """Of (key, n_key, __t, n, sketch, root): (key, __t, n, root) of texts that may reach 0.8 with one of another root under their key."""
    pools = dealt(members, F.ceil(F.col("n_key") / BLOCK), "__t", "n", "root", "sketch")

    def each(batches):
        for batch in batches:
            for key, t, n, root, s in zip(*batch.columns, strict=True):
                t, n, root = (np.array(x.values, np.int64) for x in (t, n, root))
                s = np.frombuffer(b"".join(s.as_py()), np.uint8).reshape(len(t), -1)
                has = np.zeros(len(t), bool)
                for i in range(len(t) - 1):
                    rest = np.flatnonzero(root[i + 1 :] != root[i]) + i + 1
                    rest = rest[5 * np.minimum(n[rest], n[i]) >= 4 * np.maximum(n[rest], n[i])]
                    rest = rest[(s[rest] == s[i]).sum(axis=1) >= SKETCH]
                    has[rest] = True
                    has[i] |= len(rest) > 0
                yield pa.RecordBatch.from_arrays([pa.repeat(key, int(has.sum())), *(pa.array(x[has], pa.int64()) for x in (t, n, root))], ["key", "__t", "n", "root"])

    return pools.mapInArrow(each, "key long, __t long, n long, root long").distinct()


def forest(t: np.ndarray, root: np.ndarray, sets_: list[np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links of 0.8 or more among some texts, but for what their roots already join.

    Common shingles are counted over the lists of texts of each shingle; no pair is compared by itself.
    """
    size = np.array([len(x) for x in sets_])
    _, ids = np.unique(np.concatenate(sets_), return_inverse=True)
    owner = np.repeat(np.arange(len(t)), size)[np.argsort(ids, kind="stable")]
    held = np.bincount(ids)
    first, edges, root = np.cumsum(held) - held, [], np.unique(root, return_inverse=True)[1]
    for i, own in enumerate(np.split(ids, np.cumsum(size)[:-1])):
        k = held[own]
        common = np.bincount(owner[np.repeat(first[own] - np.cumsum(k) + k, k) + np.arange(k.sum())], minlength=len(t))
        for j in np.flatnonzero((5 * common >= 4 * (size[i] + size - common)) & (root != root[i])):
            if root[i] != root[j]:
                edges.append((int(t[i]), int(t[j])))
                root[root == root[j]] = root[i]
    return edges


def joined(members: DataFrame, own: DataFrame) -> DataFrame:
    """(u, v): of (key, __t, n, root) and (__t, shingles), links between different roots that keep every component whole."""
    sizes = written(members.groupBy("key").agg(F.count("*").alias("k"), F.sum("n").alias("all")), "sizes")
    rows = members.join(sizes, "key").join(own, "__t")
    pools = dealt(rows, F.greatest(F.ceil(F.col("k") / POOL_TEXTS), F.ceil(F.col("all") / POOL_SHINGLES), F.lit(1).cast("long")), "__t", "root", "shingles").drop("key")

    def each(batches):
        for batch in batches:
            for t, root, held in zip(*batch.columns, strict=True):
                lists = held.values
                edges = forest(np.array(t.values, np.int64), np.array(root.values, np.int64), [np.array(x.values, np.int64) for x in lists])
                yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], ["u", "v"])

    return pools.mapInArrow(each, "u long, v long").distinct()


def groups(heads: DataFrame) -> DataFrame:
    """(__t, key): a key for each component of fingerprints that SimHash links of at most MOST bits join."""
    own = written(heads.select("fp").distinct(), "fingerprints")
    roots = components(simhash.links(own.select("fp", F.col("fp").alias("root")), MOST, ring_masks()))
    roots = written(roots.withColumnRenamed("node", "fp"), "groups")
    return heads.select("__t", "fp").join(roots, "fp", "left").select("__t", F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"))


def links(heads: DataFrame, docs: DataFrame) -> DataFrame:
    """(u, v): confirmed links of text hashes that keep every component whole."""
    keys = heads.select("__t", F.explode("bands").alias("key")).unionByName(groups(heads))
    met = written(keys.groupBy("key").agg(F.count("*").alias("n_key"), F.min("__t").alias("u")).where("n_key > 1"), "met")
    members = written(keys.join(met, "key"), "members")
    star = members.select("u", F.col("__t").alias("v")).where("u <> v").distinct()
    found = written(confirmed(star, heads, docs), "links")
    rooted = members.where("n_key > 2").join(components(found).withColumnRenamed("node", "__t"), "__t", "left").select("key", "n_key", "__t", F.coalesce("root", "__t").alias("root"))
    rooted = written(rooted, "rooted")
    apart = written(rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("key"), "apart")
    rest = rooted.join(apart, "key", "left_semi").join(heads.select("__t", "n", "sketch"), "__t")
    rest = written(promising(rest), "promising")
    return found.unionByName(joined(rest, sets_of(rest.select("__t"), heads, docs)))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The documents, one of every component of near-duplicates."""
    named = keyed(docs)
    rows = written(marked(named), "marked")
    least = rows.groupBy("__t").agg(F.min(F.struct("__unnamed", "__d")).alias("least"), *[F.any_value(c).alias(c) for c in ("fp", "n", "sketch", "bands")])
    heads = written(least.select("__t", "least.__unnamed", "least.__d", "fp", "n", "sketch", "bands"), "heads")
    roots = components(links(heads, named)).withColumnRenamed("node", "__t")
    place = heads.select(*DOC).join(roots, "__t", "left").withColumn("root", F.coalesce("root", "__t"))
    first = place.groupBy("root").agg(F.min(F.struct("__unnamed", "__d", "__t")).alias("f")).select("f.__d", "f.__unnamed", "f.__t")
    return picked(named, written(first, "first")).select("row.*")
