"""Names that stand on many records are compared once, and blocks are joined on them."""

import random
import re

from leadmill.functions import text
from leadmill.operators import linkage

SIDE = "list_id long, idx long, name string, phone string, postal string, city string, state string, lat double, lon double"
NAMES = ["Oak Roofing", "Oak Roofing LLC", "Oaks Roof", "Elm Auto Sales", "Elm Motors", "Auto Sales", "Used Cars", "", None, "Elm & Oak Service", "Zed"]


def sides(spark, n=60):
    r = random.Random(11)
    maybe = lambda x: None if r.random() < 0.2 else x
    rows = lambda: [(i % 2, i, r.choice(NAMES), maybe(f"21255501{r.randrange(12):02}"), maybe(f"6012{r.randrange(4)}"), "Elgin", "IL", maybe(42 + r.randrange(60) / 1000), -88.0) for i in range(n)]
    return [linkage.prepared(spark.createDataFrame(rows(), SIDE)) for _ in range(2)]


def rows_of(df):
    return sorted(map(str, (tuple(x) for x in df.collect())))


def test_linked_is_what_scoring_all_candidates_gives(spark, monkeypatch):
    a, b = sides(spark)
    for similarity in (text.token_similarity, text.name_similarity):
        want = rows_of(linkage.scored(linkage.candidates(a, b), a, b, similarity=similarity))
        assert len(want) > 50 and rows_of(linkage.linked(a, b, similarity=similarity)) == want
    with monkeypatch.context() as m:
        m.setattr(linkage, "NAME_PAIRS", 3)
        assert rows_of(linkage.linked(a, b)) == want


def test_a_place_full_of_other_names_makes_no_pairs(spark):
    """Four hundred records in one zip and at one place, other names on either side: no join pairs them."""
    rows = lambda name: linkage.prepared(spark.createDataFrame([(0, i, name, None, "60120", "Elgin", "IL", 42.0, -88.0) for i in range(400)], SIDE))
    a, b = rows("Oak Roofing"), rows("Elm Motors")
    out = linkage.linked(a, b)
    assert out.count() == 0
    assert linkage.candidates(a, b).count() == 160_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("name_b") > 4 and "CartesianProduct" not in out._jdf.queryExecution().executedPlan().toString()


def test_picks_of_blocks_are_those_of_all_candidates(spark):
    from leadmill.operators import enrich
    from pyspark.sql import functions as F

    a, b = sides(spark)
    b = b.withColumn("reviews", F.when(F.col("idx") % 3 > 0, F.col("idx") % 3))
    c = linkage.candidates(a, b).select(F.col("a_idx").alias("query_id"), F.col("b_idx").alias("cand_idx"), F.col("b.name").alias("name"), F.col("b.phone").alias("phone"), F.col("b.reviews").alias("reviews"))
    want = rows_of(enrich.picked(a.select(F.col("idx").alias("query_id"), "name", "phone"), c, text.token_similarity))
    assert len(want) > 30 and rows_of(enrich.picked_of_blocks(a, b, text.token_similarity)) == want


def test_other_phones_make_pairs_only_where_the_rest_can_reach_the_limit(spark, monkeypatch):
    """Two hundred records of one name at one place, other phones and zips on either side: no pair can reach the limit, and none is made."""
    rows = lambda phone, zip_: linkage.prepared(spark.createDataFrame([(0, i, "Oak Roofing", f"{phone}{i:04}", zip_, "Elgin", "IL", 42.0, -88.0) for i in range(200)], SIDE))
    a, b = rows("212555", "60120"), rows("312555", "60121")
    made = []
    monkeypatch.setattr(linkage, "_judged", lambda s, least, f=linkage._judged: made.append(s.count()) or f(s, least))
    assert linkage.linked(a, b).count() == 0 and made == [0]
    # At a lower limit they all reach it.
    assert linkage.linked(a, b, least=0.5).count() == 40_000


def test_no_score_below_the_least_name_reaches_the_limit():
    r, w = random.Random(7), linkage.WEIGHTS
    for _ in range(20_000):
        phone, zip_, least = r.random() < 0.5, r.random() < 0.5, r.choice([0.5, 0.6, 0.8])
        got = {"name": r.random(), "geo": r.choice([None, r.random(), 1.0]), "city": r.choice([None, 0.0, 1.0]), "zip": 1.0 if zip_ else r.choice([None, 0.0, linkage.SAME_PLACE]), "phone": 0.0 if phone else None}
        there = {k: v for k, v in got.items() if v is not None}
        mean = sum(w[k] * v for k, v in there.items()) / sum(w[k] for k in there)
        assert round(mean, 4) < least or got["name"] >= linkage.least_name(least, phone, zip_)


def test_a_dense_list_goes_in_few_rounds(spark, monkeypatch):
    """Every pair of 40 and 40 records, 50 edges a pass: bands alone would be 32 rounds."""
    from leadmill.operators import graph

    r = random.Random(3)
    edges = sorted(((1, i, j, r.randrange(30) / 100) for i in range(40) for j in range(40)), key=lambda e: (-e[3], e[1], e[2]))
    want, used = set(), (set(), set())
    for e in edges:
        if e[1] not in used[0] and e[2] not in used[1]:
            used[0].add(e[1]), used[1].add(e[2]), want.add(e)
    passes = []
    monkeypatch.setattr(graph, "_greedy", lambda *x, f=graph._greedy: passes.append(1) or f(*x))
    found = linkage.assigned(spark.createDataFrame(edges, "list_id long, a_idx long, b_idx long, confidence double"), together=50)
    assert {tuple(x) for x in found.collect()} == want and len(passes) < 20


def test_matches_in_bands_are_those_of_one_pass(spark, monkeypatch):
    """Ties, records with null and repeated keys, both scores: bands take what one pass takes, and the lower ones see fewer edges than there are."""
    a, b = sides(spark)
    a, b = (df.union(df.where("idx in (4, 5)")).union(df.where("idx = 7").selectExpr("list_id", "cast(null as bigint) as idx", *df.columns[2:])) for df in (a, b))
    for similarity in (text.token_similarity, text.name_similarity):
        edges = linkage.linked(a, b, similarity=similarity).select("list_id", "a_idx", "b_idx", "confidence")
        want = rows_of(linkage.assigned(edges))
        with monkeypatch.context() as m:
            m.setattr(linkage, "FEW", 0)
            made = []
            m.setattr(linkage, "assigned", lambda e, f=linkage.assigned: made.append(e.count()) or f(e))
            got = linkage.matches(a, b, similarity=similarity)
        assert len(want) > 20 and rows_of(got) == want and len(made) == 3 and sum(made) < 0.7 * edges.count()


def test_no_name_score_below_the_least_of_a_phone_reaches_the_limit():
    r, w = random.Random(5), linkage.WEIGHTS
    for _ in range(20_000):
        least = r.choice([0.6, 0.75, 0.9, 0.95])
        got = {"name": r.random(), "geo": r.choice([None, r.random(), 1.0]), "city": r.choice([None, 0.0, 1.0]), "zip": r.choice([None, 1.0, 0.0, linkage.SAME_PLACE]), "phone": 1.0}
        there = {k: v for k, v in got.items() if v is not None}
        mean = sum(w[k] * v for k, v in there.items()) / sum(w[k] for k in there)
        mean = max(mean, linkage.PHONE_FLOOR) if got["name"] >= linkage.PHONE_NAME else mean
        assert round(mean, 4) < least or got["name"] >= linkage.least_of_phone(least)


def test_pairs_measure_points_not_records(spark, monkeypatch):
    """Three hundred records at one point, others around, null places, phones and zips: each pair once, as all candidates, and few points meet."""
    from pyspark.sql import functions as F

    r = random.Random(9)
    maybe = lambda x, p=0.3: None if r.random() < p else x
    rows = lambda: [(i % 2, i, r.choice(NAMES), maybe(f"21255501{r.randrange(12):02}"), maybe(f"6012{r.randrange(4)}"), "Elgin", "IL", *((42.0, -88.0) if i < 300 else (maybe(42 + r.randrange(90) / 1000, 0.1), -88.0))) for i in range(340)]
    a, b = (linkage.prepared(spark.createDataFrame(rows(), SIDE)) for _ in range(2))
    want = rows_of(linkage.candidates(a, b).select("list_id", "a_idx", "b_idx"))
    met = []
    monkeypatch.setattr(linkage, "_near", lambda x, y, *m, f=linkage._near: met.append(f(x, y, *m).count()) or f(x, y, *m))
    for together in (1 << 10, 7):
        monkeypatch.setattr(linkage, "TOGETHER", together)
        got = linkage.pairs(a, b, linkage.BLOCK_MILES, "idx")
        assert len(want) > 40_000 and rows_of(got.select("list_id", F.col("a.idx").alias("a_idx"), F.col("b.idx").alias("b_idx"))) == want
    assert met[0] < 1000 and met[0] < met[1] < 10_000


def sent_whole(df):
    """The keys of the joins for which df, run to its end, sends a side whole to all tasks."""
    df.collect()
    return re.findall(r"BroadcastHashJoin \[(.*?)\], \[", df._jdf.queryExecution().executedPlan().toString())


def test_the_picker_sends_no_records_whole_to_all_tasks(spark, monkeypatch):
    """Nothing but names: records take little room in files, and exploded by cell they filled the driver."""
    from leadmill.operators import enrich
    from pyspark.sql import functions as F

    a, b = sides(spark)
    b = b.withColumn("reviews", F.col("idx") % 3)
    for similarity in (text.token_similarity, text.name_similarity):
        with monkeypatch.context() as m:
            keys = []
            m.setattr(enrich, "stored", lambda df, name, f=enrich.stored, keys=keys: keys.extend(sent_whole(df)) or f(df, name))
            keys += sent_whole(enrich.picked_of_blocks(a, b, similarity))
            assert keys and all(re.fullmatch(r"name_a#\d+", k) for k in keys)


def test_bound_tables_are_not_sent_whole_to_all_tasks(spark, data):
    from leadmill.plans import bindings

    for sql in (bindings.A, bindings.B, bindings.MASTER):
        assert sent_whole(bindings.bound(spark, data, sql)) == []


def test_similarities_send_no_records_whole_to_all_tasks(spark):
    """Nothing but scores of names, and which points are crowded."""
    a, b = sides(spark)
    for similarity in (text.token_similarity, text.name_similarity):
        keys = sent_whole(linkage.similarities(a, b, similarity))
        assert keys and all(re.fullmatch(r"__pair#\d+L", k) or "knownfloatingpointnormalized" in k for k in keys)
