import itertools
import random

import numpy as np

import corpus_pipeline as pipeline
from leadmill.llm import neardup
from leadmill.llm.common import components


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near(x, y):
    x, y = shingles(x), shingles(y)
    return 5 * len(x & y) >= 4 * len(x | y)


def firsts(texts):
    """The least id of every component, by all pairs."""
    root = list(range(len(texts)))
    find = lambda i: i if root[i] == i else find(root[i])
    for i, j in itertools.combinations(range(len(texts)), 2):
        if near(texts[i], texts[j]):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return {i for i in range(len(texts)) if find(i) == i}


def family(r, size, edits):
    base = [f"w{r.randrange(10**6)}" for _ in range(size)]
    for n in edits:
        own = base[:]
        for at in r.sample(range(size), n):
            own[at] = f"x{r.randrange(10**6)}"
        yield " ".join(own)


def test_stage_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    r = random.Random(4)
    # Jaccard from above 0.9 to below 0.5: SimHash alone joins what is below 0.8 and leaves apart what is above.
    texts = [t for _ in range(12) for t in family(r, r.choice([60, 200, 400]), [r.randrange(0, 12) for _ in range(12)])]
    texts += ["", None, " \n", "a b", "A B", "a c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id for x in pipeline.simhash_near_dedup(spark, docs, "").collect()} == firsts(texts)


def test_links_that_simhash_alone_would_make_are_refused(spark):
    r = random.Random(8)
    one, two = next((x, y) for x, y in (family(r, 120, [0, 6]) for _ in range(2000)) if (neardup.fingerprint(x) ^ neardup.fingerprint(y)).bit_count() <= 7 and not near(x, y))
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert pipeline.simhash_near_dedup(spark, docs, "").count() == 2


def test_blocks_hold_every_link(spark, monkeypatch):
    """Texts of one key in blocks of four: those with a partner stay, and the forests of all block pairs join what all pairs join."""
    for name, size in (("BLOCK", 4), ("POOL_TEXTS", 4), ("POOL_SHINGLES", 2000)):
        monkeypatch.setattr(neardup, name, size)
    r, factors = random.Random(2), neardup.multipliers(neardup.BANDS * neardup.ROWS)
    texts = [*family(r, 300, [2, 20] * 15), *family(r, 300, [3] * 5), *family(r, 200, [60] * 4)]
    own = [neardup.shingle_set(t, neardup._Hashes()) for t in texts]
    rows = [(1, len(own), i, len(s), bytearray(neardup.sketch(s, factors).astype(np.uint8).tobytes()), i) for i, s in enumerate(own)]
    stay = neardup.promising(spark.createDataFrame(rows, "key long, n_key long, __t long, n long, sketch binary, root long"))
    linked = {x for i, j in itertools.combinations(range(len(texts)), 2) if near(texts[i], texts[j]) for x in (i, j)}
    assert linked <= {x["__t"] for x in stay.collect()} <= set(range(35)) and stay.count() == stay.select("__t").distinct().count()
    sets = spark.createDataFrame([(i, s.view(np.int64).tolist()) for i, s in enumerate(own)], "__t long, shingles array<long>")
    got = {(x.u, x.v) for x in neardup.joined(stay, sets).collect()}
    assert all(near(texts[u], texts[v]) for u, v in got)
    roots = {x.node: x.root for x in components(spark.createDataFrame(sorted(got), "u long, v long")).collect()}
    assert {roots.get(i, i) for i in range(len(texts))} == firsts(texts)


def test_a_group_below_the_threshold_makes_no_pairs(spark):
    """Two hundred copies, no two of them at 0.8: all stay, and no table on the way grows with their pairs."""
    r = random.Random(3)
    texts = list(family(r, 200, [6] * 200))
    texts = [t for i, t in enumerate(texts) if not any(near(t, x) for x in texts[:i])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    named = neardup.keyed(docs)
    heads = neardup.marked(named).cache()
    assert len(texts) > 100 and neardup.links(heads, named).count() == 0 and pipeline.simhash_near_dedup(spark, docs, "").count() == len(texts)


def test_rows_are_told_apart_by_their_text(spark):
    r = random.Random(5)
    one, two, three = (next(family(r, 100, [0])) for _ in range(3))
    close = one.replace(one.split()[50], "other")
    assert near(one, close)
    # doc_id 5 names three texts, null four rows of two.
    docs = spark.createDataFrame([(1, one, "a"), (5, close, "b"), (5, two, "b"), (5, three, "c"), (5, three, "c"), (None, two, "d"), (None, close, "d"), (None, "lone", "d"), (None, "lone", "d")], "doc_id long, text string, __name string")
    kept = sorted((str(x.doc_id), x.text) for x in pipeline.simhash_near_dedup(spark, docs, "").collect())
    assert kept == sorted([("1", one), ("5", two), ("5", three), ("None", "lone")])
    assert pipeline.simhash_near_dedup(spark, docs, "").columns == docs.columns
    assert pipeline.simhash_near_dedup(spark, docs.limit(0), "").count() == 0


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 5, True), (2, "a b c", "y", 6, False)], "doc_id long, text string, __t string, row int, __unnamed boolean")
    got = neardup.first_of_each(docs)
    assert got.columns == docs.columns and [tuple(x) for x in got.collect()] == [(1, "a b c", "x", 5, True)]


def test_simhash_proposes_what_its_chain_and_hamming_checks_leave(spark, monkeypatch):
    """Fingerprints that agree under a ring mask but differ in more than three bits are no pair; those within three bits are, and without a common band."""
    far = 0b1111 << 40
    assert any(far & m == 0 for m in neardup.ring_masks())
    made = []
    monkeypatch.setattr(neardup, "confirmed", lambda pairs, heads, docs: made.append({(x.u, x.v) for x in pairs.collect()}) or pairs)
    docs = neardup.keyed(spark.createDataFrame([(0, "")], "doc_id long, text string"))
    for fps, want in (((0, far), set()), ((0, 0b111 << 40), {(1, 2)}), ((0, 0b111 << 40, 0b111111 << 40), {(1, 2), (1, 3)})):
        rows = [(i, False, i, fp, 1, bytearray(125), [100 + i]) for i, fp in enumerate(fps, 1)]
        heads = spark.createDataFrame(rows, "__t long, __unnamed boolean, __d long, fp long, n long, sketch binary, bands array<long>")
        neardup.links(heads, docs)
        assert made.pop() == want
