from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from leadmill.functions import dates, geo, grades, text, urls
from leadmill.sources import markup


def values(spark, f, inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def test_phone(spark):
    assert values(spark, text.phone_key, ["(305) 642-4409", "+13056424409", "642-4409", "23056424409", "", None]) == ["3056424409", "3056424409", None, None, None, None]
    assert values(spark, text.phone_display, ["13056424409", "642-4409", "none", None]) == ["(305) 642-4409", "6424409", None, None]


def test_names(spark):
    got = values(spark, text.name_words, ["The J & B Auto, LLC", "Fuego’s Grill", None, " - "])
    assert got == [["j", "b", "auto"], ["fuegos", "grill"], [], []]


@pytest.mark.parametrize("a,b", [("Coggin Honda", "Coggin Honda Jacksonville"), ("Green Light Auto Sales", "Bird Road Auto Sales"), ("G S Auto Sales", "G S Auto Sales"), ("Auto Sales", "Auto Sales"), ("", "x"), ("Walsh Roofing", "Roofing Walsh")])
def test_similarity(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a string, b string").select(text.name_words(F.col("a")).alias("a"), text.name_words(F.col("b")).alias("b"))
    got, wa, wb = df.select(text.name_similarity(F.col("a"), F.col("b")), "a", "b").first()
    if not wa or not wb:
        assert got == 0
        return
    sa, sb = set(wa), set(wb)
    own = lambda s: s - set(text.GENERIC_WORDS)
    cap = 0.5 if not own(sa) or not own(sb) else 0.45 if not own(sa) & own(sb) else 1
    want = max(SequenceMatcher(None, " ".join(wa), " ".join(wb)).ratio(), len(sa & sb) / min(len(sa), len(sb)) / 2 + len(sa & sb) / len(sa | sb) / 2)
    assert got == pytest.approx(min(want, cap), abs=1e-4)


def test_small_texts(spark):
    assert values(spark, text.zip5, ["33101-1234", "x 1234567", "12", None]) == ["33101", "12345", None, None]
    assert values(spark, text.city_key, [" St. Louis ", None]) == ["st louis", ""]
    assert values(spark, text.slug, ["Auto & Repair!", "--", None]) == ["auto-repair", "dataset", "dataset"]
    assert values(spark, text.number, ["1.5", "NaN", "x", ""]) == [1.5, None, None, None]
    assert values(spark, text.whole, ["1.9", "-1.9", "nan"]) == [1, -1, None]
    assert values(spark, text.without_place_suffix, ["Kendall CDP", "city", "New York city"]) == ["Kendall", "city", "New York"]
    assert values(spark, text.truthy, ["Yes", "TRUE", "0", None]) == [True, True, False, False]


def test_geo(spark):
    row = spark.range(1).select(geo.distance_miles(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("d"), geo.distance_miles(F.lit(5.0), F.lit(179.5), F.lit(5.0), F.lit(-179.5)).alias("over"), geo.distance_miles(F.lit(5.0), F.lit(5.0), F.lit(5.0), F.lit(5.0)).alias("zero")).first()
    assert row.d == pytest.approx(69.09, abs=0.05) and row.over < 70 and row.zero == 0
    lat, lon = geo.destination(F.lit(10.0), F.lit(179.9), F.lit(90.0), F.lit(50.0))
    p = spark.range(1).select(lat.alias("lat"), lon.alias("lon"), geo.distance_miles(F.lit(10.0), F.lit(179.9), lat, lon).alias("d")).first()
    assert p.d == pytest.approx(50, abs=1e-6) and -180 < p.lon < -179
    rings = geo.coverage_points(spark.createDataFrame([(26.0, -80.0)], "lat double, lon double"), 25.0, 16)
    far = rings.select("ring", F.round(geo.distance_miles(F.col("lat"), F.col("lon"), F.col("point_lat"), F.col("point_lon")), 3).alias("d")).groupBy("ring").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi")).orderBy("ring").collect()
    assert [tuple(r) for r in far] == [(0, 1, 0.0, 0.0), (1, 7, 12.5, 12.5), (2, 8, 25.0, 25.0)]


def test_dates_grades_urls(spark):
    assert [str(x) for x in values(spark, dates.loose_date, ["2024-02-03", "2024-02-30", "March 2023", "Mar 2023", "soon", None])] == ["2024-02-03", "None", "2023-03-01", "2023-03-01", "None", "None"]
    assert values(spark, grades.points, ["A+", " b - ", "NR", None]) == [4.33, 2.67, None, None]
    assert values(spark, urls.normalized, [" a.com ", "ftp://x", "", None]) == ["https://a.com", "ftp://x", None, None]
    assert values(spark, urls.domain, ["http://www.A.com:80/x", "b.org?q"]) == ["a.com", "b.org"]
    assert values(spark, markup.platform, ["https://www.youtube.com/x", "https://x.com/a", "https://box.com", "box.com"]) == ["youtube", "twitter", "box", "other"]
    rows = [("", None, None, None), ("a.com", 404, "", None), ("a.com", 403, "", None), ("a.com", 503, "", None), ("a.com", 418, "", None), ("a.com", 200, "Buy This Domain now", None), ("a.com", 200, "hi", None), ("a.com", None, None, "connection"), ("a.com", None, None, "odd")]
    got = [r[0] for r in spark.createDataFrame(rows, "u string, c int, b string, e string").coalesce(1).select(urls.site_status(F.col("u"), F.col("c"), F.col("b"), F.col("e"))).collect()]
    assert got == ["no_website", "dead_404", "blocked", "server_error", "dead_404", "dead_parked", "ok", "dead_unreachable", "check_failed"]
    assert values(spark, urls.connection_error, ["Could not resolve host: x", "Operation timed out", "SSL certificate", "connection reset", "?"]) == ["DNS lookup failed", "connection timed out", "TLS/certificate error", "connection refused", "connection failed"]


def test_references_are_the_standards(spark):
    import html
    import random

    r = random.Random(4)
    parts = ["&amp;", "&lt;", "&nbsp;", "&apos;", "&#39;", "&#x27;", "&#X2764;", "&#128512;", "&#0;", "&#x80;", "&#150;", "&#xD800;", "&#1114112;", "&#xFFFF;", "&#x1FFFE;", "&#11;", "&#00000039;", "&#999999999999;", "&eacute;", "&notin;", "&not", "&amp", "&ampx;", "&copy", "&CounterClockwiseContourIntegral;", "&unknown;", "&", "&&", "& ", "&;", "&#;", "&#x;", "AT&T", "B&B ", "amp;", "lt;", "#39;", "x", " ", "é", "😀", "\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(9))) for _ in range(2000)] + [None, "", *parts]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {x.k: x.t for x in df.select("k", text.entities_plain(F.col("t")).alias("t")).collect()}
    assert got == {k: None if t is None else html.unescape(t) for k, t in enumerate(texts)}
    lists = spark.createDataFrame([(texts[k : k + 3],) for k in range(0, 60, 3)] + [(None,), ([],), ([None, "&lt;"],)], "t array<string>")
    assert [x.t for x in lists.select(text.entities_plain_each(F.col("t")).alias("t")).collect()] == [[None if t is None else html.unescape(t) for t in x.t] if x.t is not None else None for x in lists.collect()]


def test_bound_of_the_ratio_and_scores_with_it(spark):
    import random
    from difflib import SequenceMatcher

    r = random.Random(8)
    words = ["roof", "roofing", "walsh", "walshs", "auto", "sales", "palm", "plumber", "plumbers", "a1", "joe"]
    pairs = [([r.choice(words) for _ in range(r.randrange(4))], [r.choice(words) for _ in range(r.randrange(4))]) for _ in range(1500)]
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a array<string>, b array<string>")
    a, b = F.col("a"), F.col("b")
    rows = df.select("k", text.most_ratio(F.array_join(a, " "), F.array_join(b, " ")).alias("most"), text.name_similarity(a, b).alias("score"), text.name_similarity(a, b, least=0.72).alias("high"), text.compared(a, b).alias("asked"), text.compared(a, b, 0.72).alias("asked_high"), text.token_score(a, b).alias("tokens"), text.gate(a, b).alias("gate")).collect()
    for x in rows:
        p, q = (" ".join(w) for w in pairs[x.k])
        ratio = SequenceMatcher(None, p, q).ratio()
        assert x.most >= ratio - 1e-12
        want = round(min(max(ratio, x.tokens), x.gate), 4) if pairs[x.k][0] and pairs[x.k][1] else 0.0
        assert abs(x.score - want) < 1e-9 and (x.high >= 0.72) == (want >= 0.72) and (x.high < 0.72 or x.high == x.score)
    assert sum(x.asked for x in rows) < 0.6 * len(rows) and sum(x.asked_high for x in rows) < 0.2 * len(rows)
