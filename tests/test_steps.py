"""Enrichment steps: what they fill, what they ask for, and that a second run redoes only what is open."""

import json

from pyspark.sql import functions as F

from leadmill.functions import text
from leadmill.plans import lifecycle, steps
from leadmill.sources import profiles

AS_OF = "2024-06-01"
PAGE = '<meta property="og:title" content="Joe"><script type="application/json">{"timeline_context_list_item_type": "INTRO_CARD_PROFILE_EMAIL", "renderer": {"context_item": {"title": {"text": "joe@fb.com"}}}}</script>'


def nodes(*items):
    return json.dumps({"data": {"search": {"nodes": [{"id": str(k), "name": n, "phone": p, "url": f"m{k}", "reviews": {"totalCount": 1, "nodes": [{"body": b, "rating": 4.0}]}} for k, (n, p, b) in enumerate(items)]}}})


def review_page(*texts, number=1):
    items = [{"id": f"{number}-{k}", "text": t, "date": {"year": "2024", "month": "3", "day": str(k + 1)}} for k, t in enumerate(texts)]
    return f"<script>window.__PRELOADED_STATE__ = {json.dumps({'businessProfile': {'customerReviews': {'page': number, 'totalPages': 2, 'items': items}}})};</script>"


def master(spark):
    fb = json.dumps([{"platform": "facebook", "url": "f1"}])
    rows = [
        (1, "Walsh Roofing", "3056424409", "Miami", "FL", "walsh.com", fb, "", "p1", 3),
        (2, "Palm Painting", None, "Miami", "FL", "palm.com/", json.dumps([{"platform": "facebook", "url": "f2"}]), "own@x.com", "p2", 1),
        (3, "No City Co", "3050000000", None, None, " ", None, None, " ", 9),
        (4, "Late Plumbing", "3050000004", "Miami", "FL", "late.com", json.dumps([{"platform": "facebook", "url": "f4"}]), None, "p4", 5),
    ]
    return spark.createDataFrame(rows, "row_id long, registry_name string, registry_phone string, registry_city string, registry_state string, registry_website string, registry_socials string, registry_email string, registry_profile_url string, reviews_total int")


def captures(spark, more=False):
    sites = [("https://walsh.com", 404, "", None, "2024-05-30 00:00:00"), ("walsh.com", 200, "", None, "2024-05-01 00:00:00"), ("palm.com/", 200, "hello", None, "2024-05-31 00:00:00"), ("late.com", 200, "", None, "2024-01-01 00:00:00")]
    city = spark.createDataFrame([("Miami", "FL", 25.77, -80.19, 400_000, "1")], "name string, state string, lat double, lon double, population int, geoid string")
    ask = lambda name: city.select(steps.map_request(F.lit(name), F.col("lat"), F.col("lon"))).first()[0]
    answers = [(ask("Walsh Roofing"), nodes(("Other", "3050000009", "x"), ("Walsh", "(305) 642-4409", "they left a mess"))), (ask("Palm Painting"), nodes(("Somebody", None, "y")))]
    pages = [("f1", PAGE), ("f2", None)]
    read = [("p1", review_page("great work", "never again")), ("p1", review_page("never again", number=2)), ("p2", review_page("not asked for"))]
    if more:
        sites.append(("late.com", None, None, "connection", "2024-05-31 12:00:00"))
        answers.append((ask("Late Plumbing"), nodes(("Late Plumbing", "3050000004", "good"))))
        pages += [("f2", PAGE), ("f4", "<html>log in</html>")]
        read.append(("p4", "<html>none</html>"))
    known = [(s, t, "negative" if "never" in t or "mess" in t else "positive") for s, t in [("registry", "great work"), ("registry", "never again"), ("mapquest", "they left a mess"), *([("mapquest", "good")] if more else [])]]
    cache = spark.createDataFrame(known, "source string, t string, sentiment string").select("source", text.text_hash(F.col("t")).alias("text_hash"), "sentiment", F.lit(3).alias("severity"), F.lit("th").alias("theme"), F.lit("su").alias("summary"), F.lit(True).alias("actionable"))
    return [
        steps.sites(spark.createDataFrame(sites, "url string, code int, body string, error string, checked_at string"), AS_OF), steps.map_search(spark.createDataFrame(answers, "request string, body string"), city),
        steps.social_profiles(spark.createDataFrame(pages, "url string, html string")), steps.review_texts(spark.createDataFrame(read, "profile_url string, html string")), steps.sentiment(cache),
    ]


def asked(rows, found):
    out = {}
    for r in steps.work_list(rows, found).collect():
        out[r.step] = out.get(r.step, 0) + 1
    return out


def test_steps_fill_what_is_answered_and_leave_the_rest_open(spark):
    first = captures(spark)
    rows = steps.applied(master(spark), first)
    got = {r.row_id: r for r in rows.collect()}
    assert len(got) == 4 and set(master(spark).columns) <= set(rows.columns)
    assert [(got[k].registry_website_status, got[k].registry_website_dead) for k in (1, 2, 3, 4)] == [("dead_404", True), ("ok", False), ("no_website", False), (None, None)]
    states = {r.row_id: r.s for r in rows.select("row_id", steps.cell_state(F.col("mapquest_reviews")).alias("s")).collect()}
    assert states == {1: "found", 2: "none", 3: "open", 4: "open"} and (got[1].mapquest_url, got[1].mapquest_review_count) == ("m1", 1.0)
    assert [got[k].facebook_status for k in (1, 2, 3, 4)] == ["ok", "check_failed", "no_facebook_link", None]
    assert [(got[k].registry_email, got[k].registry_email_source) for k in (1, 2)] == [("joe@fb.com", "facebook"), ("own@x.com", None)]
    assert [got[k].registry_num_reviews_captured for k in (1, 2, 3, 4)] == [3, None, None, None]
    assert (got[1].review_sentiment_analyzed_count, got[1].review_sentiment_negative_count, got[1].most_recent_review_source) == (4, 3, "registry")
    assert got[2].review_sentiment_analyzed_count is None

    # The same captures again: only what is open is asked for, and nothing changes.
    assert asked(master(spark), first) == {"sites": 3, "map_search": 3, "social_profiles": 3, "review_texts": 2} and asked(rows, first) == {"sites": 1, "map_search": 1, "social_profiles": 2, "review_texts": 1}
    again = steps.applied(rows, first)
    assert sorted(map(str, again.select(*sorted(rows.columns)).collect())) == sorted(map(str, rows.select(*sorted(rows.columns)).collect()))

    # New answers fill the open rows; what was found stays.
    second = captures(spark, more=True)
    later = {r.row_id: r for r in steps.applied(rows, second).collect()}
    assert later[1] == got[1] | later[1] if isinstance(later[1], dict) else all(later[1][c] == got[1][c] for c in rows.columns)
    assert (later[4].registry_website_status, later[4].mapquest_review_count, later[4].facebook_status, later[4].registry_reviews, later[4].review_sentiment_analyzed_count) == ("dead_unreachable", 1.0, "unavailable", "[]", 1)
    assert later[2].facebook_status == "ok" and later[2].registry_email == "own@x.com"


def test_addresses_from_the_right(spark):
    rows = {"1 Main St, Unit 2, Elgin, IL 60120": ("1 Main St, Unit 2", "Elgin", "IL", "60120"), "Elgin, IL 60120-1234": (None, "Elgin", "IL", "60120-1234"), "Elgin, Il 60120": (None,) * 4, "Elgin, IL 6012": (None,) * 4, "IL 60120": (None,) * 4, ", IL 60120": (None,) * 4, "serves the county": (None,) * 4, "-, Elgin, IL  60120": (None, "Elgin", "IL", "60120"), "": (None,) * 4}
    df = spark.createDataFrame([(k,) for k in [*rows, None]], "raw string")
    got = {r.raw: tuple(r.p) for r in df.select("raw", profiles.split_address(F.col("raw")).alias("p")).collect()}
    assert got == rows | {None: (None,) * 4}


def test_lifecycle_runs_all_steps(spark):
    rows, work = lifecycle.enriched(master(spark), captures(spark))
    assert rows.where("registry_website_status is not null").count() == 3 and {r.step for r in work.collect()} == {"sites", "map_search", "social_profiles", "review_texts"}
