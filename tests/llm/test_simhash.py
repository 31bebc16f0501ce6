import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from leadmill.llm import simhash
from leadmill.llm.common import components


def slow_fingerprint(text, words=3):
    w = bytes(x for x in (text or "").encode().lower()).split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + words]) for i in range(max(1, len(w) - words + 1))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, most):
    root = list(range(len(fps)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= most:
            root[find(i)] = find(j)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least.get(find(i)) for i in range(len(fps))]


def test_fingerprints(spark):
    r = random.Random(0)
    texts = [None, "", " \n\t", "A b", "a B c", "É É é é\x1c x", *(" ".join(r.choice(["foo", "Bar", "baz", "é"]) for _ in range(r.randrange(1, 80))) for _ in range(30))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fp & simhash.FULL for r in simhash.fingerprints(docs).collect()}
    assert got == {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] & simhash.FULL == xxhash.xxh64_intdigest(b"a b c", 42)


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000))
    want = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "PIECE", 7)
    assert simhash.fingerprint(text) == want == slow_fingerprint(text)


def test_no_near_pair_is_missed():
    r = random.Random(1)
    masks = [m & simhash.FULL for m in simhash.ring_masks()]
    for bits in itertools.chain(itertools.combinations(range(64), 2), (r.sample(range(64), 3) for _ in range(20_000))):
        x = sum(1 << b for b in bits)
        assert any(not x & m for m in masks)
    x = np.array([sum(1 << b for b in r.sample(range(64), k)) for k in (0, 1, 2, 3) for _ in range(300)], np.uint64)
    assert simhash.chained(x, 3).all() and not simhash.chained(np.array([simhash.FULL], np.uint64), 3).any()


def near_group(r, n):
    """Fingerprints around some centres, dense enough for large buckets."""
    out = []
    for _ in range(n):
        c = r.getrandbits(64)
        out += [c ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 4))) for _ in range(r.choice([1, 2, 40]))]
    return out


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)  # several blocks in a bucket
    r = random.Random(5)
    fps = near_group(r, 25)
    df = spark.createDataFrame([(simhash._signed(f),) * 2 for f in set(fps)], "fp long, root long")
    roots = {x.node & simhash.FULL: x.root for x in components(simhash.links(df, 3, simhash.ring_masks())).collect()}
    distinct = sorted(set(fps))
    want = brute_components(distinct, distinct, 3)
    groups = {}
    for f, w in zip(distinct, want, strict=True):
        groups.setdefault(w, set()).add(roots.get(f, simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_component_chains(spark):
    n = 200
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000 + i, 1000) for i in range(1, 50)] + [(7, 7)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000 + i: 1000 for i in range(50)}
    assert components(edges.limit(0)).count() == 0


def test_operator(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(None, None), (9001, None), (9002, ""), (9003, "one"), (None, "one"), (9003, "one")], "doc_id long, text string")
    both = docs.unionByName(extra).withColumn("fp", F.lit("clash"))
    rows = simhash.digests(both).collect()
    texts = both.collect()
    assert len(rows) == len(texts)
    fps = [slow_fingerprint(t.text) for t in texts]
    want = brute_components(fps, [t.doc_id for t in texts], 3)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in rows) == sorted((str(t.doc_id), f"{f:016x}", w) for t, f, w in zip(texts, fps, want, strict=True))
    assert simhash.digests(both.limit(0)).count() == 0


def test_longer_masks_miss_no_pair():
    r = random.Random(2)
    for _ in range(3000):
        mask = r.choice(simhash.ring_masks()) & simhash.FULL
        open_ = [b for b in range(64) if not mask >> b & 1]
        x = sum(1 << b for b in r.sample(open_, r.randrange(4)))
        for _ in range(simhash.ROUNDS):
            mask = next(m for m in (m & simhash.FULL for m in simhash.longer_masks(mask, 3)) if not x & m)
        assert 64 - mask.bit_count() <= 14 and simhash.most_under(3) == 4096


def test_crowded_keys_are_dealt_in_proportion(spark, monkeypatch):
    """Fingerprints that all agree under one mask: rows in arrays grow as the fingerprints do, and components equal brute force."""
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r, rows = random.Random(7), []
    mask, base = simhash.ring_masks()[0] & simhash.FULL, r.getrandbits(64)
    for n in (3200, 800):
        fps = set()
        while len(fps) < n:
            f = base & mask | r.getrandbits(64) & ~mask & simhash.FULL
            fps |= {f, f ^ (1 << r.choice([b for b in range(64) if not mask >> b & 1]))} if r.random() < 0.1 else {f}
        df = spark.createDataFrame([(simhash._signed(f),) * 2 for f in sorted(fps)[:n]], "fp long, root long")
        _, pools = simhash.met_under(df, 3, simhash.ring_masks())
        rows.append(pools.agg(F.sum(F.size("fps"))).first()[0] or 0)
    assert rows[0] <= 24 * 3200 and rows[1] <= 24 * 800  # pairs of blocks would hold 200 and 50 rows a fingerprint
    distinct = sorted(fps)[:n]
    roots = {x.node & simhash.FULL: x.root for x in components(simhash.links(df, 3, simhash.ring_masks())).collect()}
    groups = {}
    for f, w in zip(distinct, brute_components(distinct, distinct, 3), strict=True):
        groups.setdefault(w, set()).add(roots.get(f, simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups) < n


def test_roots_leave_no_link_out(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 8)
    r = random.Random(6)
    distinct = sorted(set(near_group(r, 12)))
    want = brute_components(distinct, distinct, 3)
    # Any coarser start, here pairs of one component, must end in the same components.
    some = {w: [f for f, x in zip(distinct, want, strict=True) if x == w][:7] for w in set(want)}
    start = {f: simhash._signed(min(g)) for g in some.values() for f in g}
    df = spark.createDataFrame([(simhash._signed(f), start.get(f, simhash._signed(f))) for f in distinct], "fp long, root long")
    given = spark.createDataFrame([(simhash._signed(f), x) for f, x in start.items()] or [(0, 0)], "u long, v long")
    roots = {x.node & simhash.FULL: x.root for x in components(simhash.links(df, 3, simhash.ring_masks()).unionByName(given)).collect()}
    groups = {}
    for f, w in zip(distinct, want, strict=True):
        groups.setdefault(w, set()).add(roots.get(f, simhash._signed(f)))
    assert all(len(g) == 1 for g in groups.values()) and len(set().union(*groups.values())) == len(groups)
