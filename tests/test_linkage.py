import math
import random
import re
from collections import Counter, namedtuple
from decimal import ROUND_HALF_UP, Decimal
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from leadmill.functions import text
from leadmill.operators import dedupe, enrich, linkage
from leadmill.plans import queries as plans
from leadmill.plans.bindings import A, B, bound

SIDE = "list_id long, idx long, name string, phone string, postal string, city string, state string, lat double, lon double"


@pytest.mark.parametrize("together", [None, 40, 7])
def test_assignment_is_the_sequential_greedy(spark, together):
    """Lists dealt whole, cut into components, and cut into bands; with a chain of improving edges, where rounds of mutual best take one edge each."""
    r = random.Random(1)
    edges = {(r.randrange(4), r.randrange(9), r.randrange(9)): r.choice([0.6, 0.7, 0.8, 0.9]) for _ in range(60)}
    edges |= {(9, 100 + k, 100 + (k + j)): round(0.6 + (2 * k + j) / 1000, 4) for k in range(40) for j in (0, 1)}
    edges |= {(9, 200 + k, 200 + k): 0.7 for k in range(5)}
    df = spark.createDataFrame([(*k, v, "x") for k, v in edges.items()], "list_id long, a_idx long, b_idx long, confidence double, more string")
    found = linkage.assigned(df, together=together)
    assert found.columns == df.columns
    got = {tuple(x) for x in found.select("list_id", "a_idx", "b_idx").collect()}
    want, a, b = set(), set(), set()
    for (g, x, y), _ in sorted(edges.items(), key=lambda e: (-e[1], e[0])):
        if (g, x) not in a and (g, y) not in b:
            want.add((g, x, y)), a.add((g, x)), b.add((g, y))
    assert got == want
    assert linkage.assigned(df.where("confidence > 2"), together=together).collect() == []


def test_rounds_do_not_grow_with_chains(spark):
    """A chain of improving edges is one task's pass: the jobs of ten edges and of a thousand are as many."""
    tracker = spark.sparkContext.statusTracker()

    def jobs(n):
        spark.sparkContext.setJobGroup(f"chain{n}", "")
        df = spark.createDataFrame([(0, k, k + j, 0.5 + (2 * k + j) / 1e5) for k in range(n) for j in (0, 1)], "list_id long, a_idx long, b_idx long, confidence double")
        assert linkage.assigned(df).count() == n
        return len(tracker.getJobIdsForGroup(f"chain{n}"))

    assert jobs(10) == jobs(1000)
    spark.sparkContext.setJobGroup("rest", "")


def test_components(spark):
    from leadmill.operators import graph

    r = random.Random(3)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(90)] + [(1000 + k, 1001 + k) for k in range(100)] + [(5000, 5001 + k) for k in range(50)] + [(7, 7), (1, 2), (2, 1)]
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for x, y in pairs:
        x, y = find(x), find(y)
        least[max(x, y)] = min(x, y)
    want = {x: find(x) for x in least}
    got = {t.node: t.root for t in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    alone = {x for x, _ in pairs} - set(got)
    assert got == {x: y for x, y in want.items() if x not in alone} and alone <= {x for x, y in pairs if x == y}


def test_linkage_rules(spark):
    a = spark.createDataFrame([(0, 0, "Walsh Roofing LLC", "305-642-4409", "33101", "Miami", "fl", 25.0, -80.0), (0, 1, "Palm Painting", None, "33101", "Miami", "FL", 25.01, -80.0), (0, 2, "Auto Sales", None, "33999", None, None, None, None), (1, 3, "Walsh Roofing", "3056424409", None, None, None, None, None)], SIDE)
    b = spark.createDataFrame([(0, 0, "Walsh Roofing", "+1 (305) 642 4409", None, None, None, None, None), (0, 1, "Palm Painting Co", None, None, "Miami", "FL", 25.011, -80.0), (0, 2, "Other Business", None, "33101", "Miami", "FL", 25.3, -80.3)], SIDE)
    x, y = linkage.prepared(a), linkage.prepared(b)
    pairs = linkage.candidates(x, y)
    assert {(r.a_idx, r.b_idx) for r in pairs.collect()} == {(0, 0), (0, 1), (0, 2), (1, 1), (1, 2)}
    scored = linkage.scored(pairs, x, y)
    assert {(r.a_idx, r.b_idx): r.band for r in scored.collect()} == {(0, 0): "confident", (1, 1): "confident"}
    rows = linkage.outcome(x, y, linkage.assigned(scored))
    assert linkage.summary(rows).first().asDict() == {"a_total": 4, "b_total": 3, "matched": 2, "confident": 2, "review": 0, "a_only": 2, "b_only": 1}
    assert linkage.master(a, b, rows, include_b_only=False).count() == 4


def test_geo_block_equals_all_pairs(spark):
    r = random.Random(4)
    place = lambda n: spark.createDataFrame([(0, i, 25 + r.random() / 3, -80 + r.random() / 3) for i in range(n)], "list_id long, idx long, lat double, lon double")
    a, b = place(60), place(60)
    from leadmill.functions import geo

    every = a.alias("a").crossJoin(b.alias("b")).where(geo.distance_miles(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= 3).select("a.idx", "b.idx").collect()
    assert sorted(map(tuple, every)) == sorted((x.a_idx, x.b_idx) for x in linkage.near(a, b, 3.0).collect())


def test_blocks_are_equi_joins(spark):
    x = linkage.prepared(spark.createDataFrame([], SIDE))
    plan = linkage.candidates(x, x)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_dedupe(spark):
    rows = spark.createDataFrame([(0, "3056424409"), (1, "(305) 642-4409"), (2, None), (3, None), (4, "12")], "row_idx long, phone string")
    assert sorted(r.row_idx for r in dedupe.by_phone(rows, "phone", [F.col("row_idx")]).collect()) == [0, 2, 3, 4]
    once = dedupe.by_id(rows, "phone")
    assert sorted(r.row_idx for r in once.collect()) == [0, 1, 2, 4]
    assert sorted(r.row_idx for r in dedupe.by_id(once, "phone").collect()) == [0, 1, 2, 4]


def test_phone_first(spark):
    kind = "list_id long, {} long, name string, phone string, city string, postal string"
    rows = spark.createDataFrame([(0, 0, "A One", "3050000001", None, None), (0, 1, "B Two", "305-000-0001", None, None), (0, 2, "Palm Painting", None, "Miami", None), (0, 3, "Palm Painting", None, "Miami", None), (0, 4, "Nobody", None, None, None)], kind.format("row_idx"))
    other = spark.createDataFrame([(0, 0, "A One", "3050000001", None, None), (0, 1, "Copy", "(305) 000-0001", None, None), (0, 2, "Palm Painting Inc", None, "miami", None), (0, 3, "Fresh", "3050000009", None, None)], kind.format("idx"))
    got = {(r.row_idx, r.other_idx, r.how) for r in enrich.phone_first(rows, other).collect()}
    assert got == {(0, 0, "phone"), (1, 0, "phone"), (2, 2, "place"), (3, None, "none"), (4, None, "none"), (None, 3, "new")}


def test_picker(spark):
    q = spark.createDataFrame([(1, "Walsh Roofing", "3056424409"), (2, "Walsh Roofing", "3056424409"), (3, "Walsh Roofing", "3050000000"), (4, "Walsh Roofing", "12"), (5, "Walsh Roofing", None)], "query_id long, name string, phone string")
    c = spark.createDataFrame([(1, 0, "x", "3056424409", 4), (1, 1, "Walsh Roofing", None, 9), (2, 0, "x", "3056424409", 0), (2, 1, "Walsh Roofing", None, 9), (3, 0, "Walsh Roofing", None, 9), (4, 0, "Walsh Roofing", None, 0), (4, 1, "Walsh Roofing", None, 3), (5, 0, "Something", None, 3)], "query_id long, cand_idx long, name string, phone string, reviews int")
    assert {r.query_id: r.cand_idx for r in enrich.picked(q, c).collect()} == {1: 0, 2: 1, 3: None, 4: 0, 5: None}


def test_full_similarity_decides(spark):
    a = spark.createDataFrame([(0, 0, "Plumber Joe", None, "33101", None, None, None, None)], SIDE)
    b = spark.createDataFrame([(0, 0, "Plumbers Joe", None, "33101", None, None, None, None)], SIDE)
    x, y = linkage.prepared(a), linkage.prepared(b)
    pairs = linkage.candidates(x, y)
    full, tokens = linkage.signals(pairs, x, y).first(), linkage.signals(pairs, x, y, text.token_similarity).first()
    assert full.sig_name > tokens.sig_name


# --- the queries on the full name score, beside plain Python --------------------------------------------------------
def half_up(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.0001"), ROUND_HALF_UP))


def words(name):
    s = name.lower().replace("&", " and ").replace("'", "").replace("’", "")
    return [w for w in re.sub("[^a-z0-9 ]", " ", s).split() if w not in text.NAME_NOISE]


def similarity(x, y):
    if not x or not y:
        return 0.0
    a, b = set(x), set(y)
    tokens = 0.5 * (len(a & b) / min(len(a), len(b))) + 0.5 * (len(a & b) / len(a | b))
    own, other = a - set(text.GENERIC_WORDS), b - set(text.GENERIC_WORDS)
    cap = 0.5 if not own or not other else 0.45 if not own & other else 1.0
    return half_up(min(max(SequenceMatcher(None, " ".join(x), " ".join(y)).ratio(), tokens), cap))


def digits(phone):
    d = re.sub("[^0-9]", "", phone or "")
    d = d[1:] if len(d) == 11 and d[0] == "1" else d
    return d if len(d) == 10 else None


def zip5(c):
    m = re.search("[0-9]{5}", c or "")
    return m and m[0]


def miles(x, y):
    if None in (x.lat, x.lon, y.lat, y.lon):
        return None
    p, q = math.radians(x.lat), math.radians(y.lat)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(y.lon - x.lon) / 2) ** 2
    return 2 * 3958.8 * math.asin(math.sqrt(min(1, h)))


def city(c):
    return re.sub("[^a-z0-9 ]", "", (c or "").lower()).strip()


def blocked(a, b):
    for x in a:
        for y in b:
            far = miles(x, y)
            if x.list_id == y.list_id and ((digits(x.phone) and digits(x.phone) == digits(y.phone)) or (zip5(x.postal) and zip5(x.postal) == zip5(y.postal)) or (far is not None and far <= 3)):
                yield x, y, far


def edges(a, b):
    """{(list, a, b): (name score, confidence)} of the pairs worth assigning."""
    out = {}
    for x, y, far in blocked(a, b):
        sig, cx, cy = {"name": similarity(words(x.name), words(y.name))}, city(x.city), city(y.city)
        if digits(x.phone) and digits(y.phone):
            sig["phone"] = float(digits(x.phone) == digits(y.phone))
        if far is not None:
            sig["geo"] = max(0.0, 1 - far / 2)
        if zip5(x.postal) and zip5(y.postal):
            sig["zip"] = 1.0 if zip5(x.postal) == zip5(y.postal) else 0.4 if cx == cy != "" and x.state.strip().upper() == y.state.strip().upper() else 0.0
        if cx and cy:
            sig["city"] = float(cx == cy)
        mean = sum(linkage.WEIGHTS[k] * v for k, v in sig.items()) / sum(linkage.WEIGHTS[k] for k in sig)
        mean = max(mean, 0.9) if sig.get("phone") == 1 and sig["name"] >= 0.55 else mean
        if (sig.get("phone") == 1 or sig["name"] >= 0.5) and half_up(mean) >= 0.6:
            out[x.list_id, x.idx, y.idx] = sig["name"], half_up(mean)
    return out


def greedy(ranked):
    a, b, out = set(), set(), []
    for g, x, y in ranked:
        if (g, x) not in a and (g, y) not in b:
            out.append((g, x, y)), a.add((g, x)), b.add((g, y))
    return out


@pytest.fixture(scope="module")
def sides(spark, data):
    return [bound(spark, data, side).collect() for side in (A, B)]


def rows_of(spark, data, name):
    return [tuple(r) for r in plans.QUERIES[name](spark, data).collect()]


def test_full_scores_and_assignment(spark, data, sides):
    want = edges(*sides)
    got = {r[:3]: r[3:] for r in rows_of(spark, data, "pair_confidence_full")}
    assert want and set(got) == set(want)
    for k, (name, confidence) in want.items():
        assert got[k][0] == name and abs(got[k][1] - confidence) <= 1e-4 and got[k][2] == ("confident" if got[k][1] >= 0.8 else "review")
    taken = greedy(sorted(got, key=lambda k: (-got[k][1], k[1], k[2])))
    matched = rows_of(spark, data, "greedy_match_full")
    assert {r[:3] for r in matched} == set(taken)
    a, b = (len(x) for x in sides)
    sure = sum(got[k][1] >= 0.8 for k in taken)
    assert rows_of(spark, data, "match_summary_full") == [(a, b, len(taken), sure, len(taken) - sure, a - len(taken), b - len(taken))]
    names = [{(r.list_id, r.idx): r.name for r in x} for x in sides]
    wide = Counter((r[0], r[1], r[2]) for r in rows_of(spark, data, "master_union_full"))
    both = Counter((0, names[0][g, x], names[1][g, y]) for g, x, y in taken)
    only = Counter((1, n, None) for k, n in names[0].items() if k not in {(g, x) for g, x, _ in taken})
    assert wide == both + only + Counter((2, None, n) for k, n in names[1].items() if k not in {(g, y) for g, _, y in taken})


def test_full_similarity_of_blocked_pairs(spark, data, sides):
    want = {(x.idx, y.idx): similarity(words(x.name), words(y.name)) for x, y, _ in blocked(*sides)}
    assert {r[:2]: r[2] for r in rows_of(spark, data, "name_similarity_full")} == want


def test_full_phone_first(spark, data, sides):
    a, b = ([r for r in sorted(side, key=lambda r: r.idx)] for side in sides)
    usable, seen = [], set()
    for y in b:
        if digits(y.phone) is None or (y.list_id, digits(y.phone)) not in seen:
            usable.append(y)
        seen.add((y.list_id, digits(y.phone)))
    phones = {(y.list_id, digits(y.phone)): y for y in reversed(usable) if digits(y.phone)}
    found, claimed = {}, {}
    for x in a:
        if digits(x.phone) and (y := phones.get((x.list_id, digits(x.phone)))):
            found[x.list_id, x.idx] = y.idx, "phone"
            claimed.setdefault((x.list_id, y.idx), x.idx)
    pairs = [(x.list_id, x.idx, y.idx) for x in a for y in usable if x.list_id == y.list_id and (x.list_id, x.idx) not in found and ((city(x.city) and city(x.city) == city(y.city)) or (zip5(x.postal) and zip5(x.postal) == zip5(y.postal)))
             and claimed.get((y.list_id, y.idx), math.inf) > x.idx and similarity(words(x.name), words(y.name)) >= 0.72]
    for g, x, y in greedy(sorted(pairs, key=lambda k: k[1:])):
        found[g, x] = y, "place"
    want = {(g, x, y, how) for (g, x), (y, how) in found.items()} | {(x.list_id, x.idx, None, "none") for x in a if (x.list_id, x.idx) not in found}
    want |= {(y.list_id, None, y.idx, "new") for y in usable if (y.list_id, y.idx) not in {(g, y) for (g, _), (y, _) in found.items()}}
    got = rows_of(spark, data, "phone_first_join_full")
    assert len(got) == len(want) and set(got) == want


def test_full_picker(spark, data, sides):
    near, n = {}, {y.idx: 0 if y.idx % 3 == 0 else y.review_count for y in sides[1]}
    for x, y, _ in blocked(*sides):
        near.setdefault((x.idx, x.name, digits(x.phone)), []).append(y)
    want = {}
    for (idx, name, phone), others in near.items():
        best = lambda some, least: next((y.idx for s, _, y in sorted(((similarity(words(name), words(y.name)), -y.idx, y) for y in some), key=lambda t: t[:2], reverse=True) if s >= least), None)  # noqa: E731, B023
        hit = min((y.idx for y in others if phone and digits(y.phone) == phone), default=None)
        if phone:
            sibling = best([y for y in others if y.idx != hit and n[y.idx] > 0], 0.9) if hit is not None and n[hit] <= 0 else None
            want[idx] = hit if sibling is None else sibling
        else:
            want[idx] = best(others, 0.85)
    assert dict(rows_of(spark, data, "picker_full")) == want


def test_geo_block_near_the_pole_and_across_the_date_line(spark):
    r = random.Random(6)
    spots = [(0, i, r.choice([78.2, 89.95, -84.0]) + r.random() / 30, (179.9 + r.random() / 5 + 180) % 360 - 180 if i % 2 else r.random() * 360 - 180) for i in range(120)]
    df = spark.createDataFrame(spots, "list_id long, idx long, lat double, lon double")
    kind = namedtuple("kind", "lat lon")
    want = sorted((a[1], b[1]) for a in spots for b in spots if miles(kind(*a[2:]), kind(*b[2:])) <= 3)
    assert len(want) > 200 and want == sorted((x.a_idx, x.b_idx) for x in linkage.near(df, df, 3.0).collect())


def test_containment_beside_all_pairs(spark):
    from leadmill.operators import lookup

    r = random.Random(10)
    make = lambda n: sorted({"".join(r.choice("abc ") for _ in range(r.randrange(0, 7))) for _ in range(n)})
    p, t = make(120), make(150)
    found = lookup.contained(spark.createDataFrame([(x,) for x in p], "p string"), spark.createDataFrame([(x,) for x in t], "t string"))
    assert sorted(map(tuple, found.collect())) == sorted((x, y) for x in p for y in t if x and x in y)
    known = spark.createDataFrame([(str(k), x) for k, x in enumerate(["Roofing", "Plumber", "Auto Repair", "Auto", "plumber", None, " "])], "id string, name string")
    asked = spark.createDataFrame([("Plumbers",), ("roofing",), (" AUTO ",), ("auto repair shop",), ("zzz",), ("",), (None,), ("o",)], "query string")
    got = {x["query"]: (x.n, x.category_id) for x in lookup.categories(asked, known).collect()}
    assert got == {"Plumbers": (2, None), "roofing": (1, "0"), " AUTO ": (1, "3"), "auto repair shop": (2, None), "zzz": (0, None), "o": (3, None)}
    plan = lookup.categories(asked, known)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
