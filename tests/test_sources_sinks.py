import json

import pytest
from pyspark.sql import functions as F

from leadmill.operators import browse, publish
from leadmill.sinks import versions, writers
from leadmill.sources import capture, markup, payloads, profiles, social, tables
from leadmill.streaming import ingest


def test_reference_tables(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps([{"id": "1", "name": "Roofing", "slug": "roofing"}]))
    assert tables.categories(spark, str(tmp_path / "c.json")).first().slug == "roofing"
    assert tables.categories(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "cities.csv").write_text("name,state,lat,lon,population,geoid\nMiami,FL,25.7,-80.2,400000,1\nBad,FL,x,y,z,2\n")
    assert [r.name for r in tables.cities(spark, str(tmp_path / "cities.csv")).collect()] == ["Miami"]
    (tmp_path / "g.txt").write_bytes("USPS|GEOID|NAME  \nPR|7|Añasco zona urbana \n".encode("latin-1"))
    assert tables.gazetteer(spark, str(tmp_path / "g.txt")).first().name == "Añasco zona urbana"
    (tmp_path / "a.csv").write_text('name,phone\n"A, ""q"" Co",1\n')
    (tmp_path / "b.csv").write_text("name,city\nB,\n")
    got = tables.listing_csv(spark, str(tmp_path / "b.csv"), str(tmp_path / "a.csv")).orderBy("row_idx").collect()
    assert [(r.name, r.phone, r.city) for r in got] == [('A, "q" Co', "1", None), ("B", None, None)]


def test_payloads(spark):
    page = {"page": 1, "pageSize": 15, "totalPages": 2, "totalResults": 700, "location": {"latLng": "25.7,-80.2"}, "results": [{"id": "x_1", "businessName": " A  Co ", "phone": ["3056424409", "1"], "location": "1.5,2.5", "categories": [{"id": "1", "name": "R"}]}, {"id": "x_2"}, {"id": "x_3", "businessName": "B", "location": "bad"}]}
    df = spark.createDataFrame([("q", json.dumps(page)), ("r", "no json")], "q string, body string")
    got = payloads.listing_pages(df).collect()
    assert [(r.q, r.listing_id, r.name, r.phone, r.lat, r.categories) for r in got] == [("q", "x_1", "A Co", "(305) 642-4409", 1.5, ["R"]), ("q", "x_3", "B", None, None, None)]
    assert payloads.page_centers(df).where("q = 'q'").select("lat", "lon", "reachable").first() == (25.7, -80.2, 30)
    nodes = {"data": {"search": {"nodes": [{"id": "n", "name": "N", "phone": "1", "reviews": {"totalCount": 1, "nodes": [{"body": "t", "rating": 9.0}]}}, {"name": "no id"}]}}}
    m = payloads.map_search(spark.createDataFrame([(1, json.dumps(nodes))], "query_id long, body string")).collect()
    assert len(m) == 1 and m[0].review_list[0].rating == 4.5
    local = [json.dumps({"businesses": [{"id": "a", "name": "A", "display_phone": "(1) 2"}, {"name": "x"}]}), json.dumps({"businesses": [{"id": "a", "name": "late"}, {"id": "b", "name": "B"}]})]
    rows = payloads.local_search(spark.createDataFrame(list(enumerate(local)), "page long, body string")).orderBy("page", "pos").collect()
    assert [(r.id, r.name, r.phone) for r in rows] == [("a", "A", "(1) 2"), ("b", "B", None)]
    keys = spark.range(1).select(payloads.cache_key(F.lit("/p"), F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))) == payloads.cache_key(F.lit("/p"), F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")))).first()
    assert keys[0]
    detail = spark.createDataFrame([({5: 80.0, 1: 20.0}, ["a", "b"], ["l"], ["h"], [("t",)], 4.567)], "m map<int, double>, categories array<string>, licenses array<string>, highlights array<string>, reviews array<struct<text: string>>, overall_rating double").withColumn("rating_breakdown", F.map_entries("m")).drop("m")
    r = payloads.detail_rows(detail).first()
    assert (r.rating_5_star_pct, r.rating_4_star_pct, r.categories, r.num_categories, r.overall_rating) == (80.0, None, "a; b", 2, 4.57)


def test_markup(spark):
    html = '<a href="b.htm">Bees</a><a href="/x/a.htm">no</a><script>window.S = {"a": "}\\"", "b": [1, {"c": 2}]} ; x()</script><script type="application/ld+json">{"k": 1}</script><script>self.__next_f.push([1,"one\\n"])</script><script>self.__next_f.push([1,"two {\\"p\\": {\\"q\\": \\"}\\"}}"])</script>'
    assert json.loads(markup.assigned(html, "S")) == {"a": '}"', "b": [1, {"c": 2}]}
    assert markup.assigned("window.S = {broken", "S") is None and markup.assigned(None, "S") is None
    assert markup.flight(html) == 'one\ntwo {"p": {"q": "}"}}'
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string").coalesce(1)
    assert [r.slug for r in markup.hub_links(df).collect()] == ["b"]
    blob = df.select(markup.flight_udf("html").alias("b")).select(markup.component(F.col("b"), "two ").alias("j")).collect()
    assert json.loads(blob[0].j) == {"p": {"q": "}"}} and blob[1].j is None
    scripts = df.select(markup.json_scripts_udf("html").alias("s")).collect()
    assert [x.json for x in scripts[0].s] == ['{"k": 1}']


def card(kind, said, **more):
    return {"timeline_context_list_item_type": social.CARDS[kind], "renderer": {"context_item": {"title": {"text": said}, **more}}}


def social_page(tree, title="Joe &amp; Co | Elgin", about="Joe. 1,234 followers · 7 talking about this. Since 1990."):
    return f'<meta property="og:title" content="{title}"><meta property="og:description" content="{about}"><script>x("timeline_context_list_item_type"</script><script type="application/json">{json.dumps(tree)}</script>'


def test_social_profiles(spark):
    deep = [card("website", "joe.com?utm=1"), card("website", "gmail.com"), card("phone", "1"), card("phone", "2"), {**card("email", "no renderer"), "renderer": None}]
    for _ in range(40):  # deeper than any fixed number of levels would reach
        deep = {"k": [0, deep, {"timeline": 1}]}
    rated = card("rating", "98% recommend (12 reviews)", url="r")
    plain = {"timeline_context_list_item_type": social.CARDS["hours_status"], "renderer": {"context_item": {"title": {}, "plaintext_title": {"text": "Open now"}}}}
    account = card("account", "see")
    account["renderer"]["context_item"]["title"]["ranges"] = [None, {"entity": {}}, {"entity": {"external_url": "https://www.youtube.com/joe"}}]
    nested = {**card("address", "1 Main St"), "inner": [card("price_range", "Price Range · $$"), card("categories", "Page · Roofer"), card("service_areas", "A · B"), card("confirmed_owner", " ")]}
    rows = [(1, social_page([deep, rated, plain, account, nested])), (2, social_page([card("phone", "3")], title="")), (3, social_page([card("rating", "Not yet rated (4 reviews)")], about="Quiet")), (4, None), (5, "<p>")]
    got = {r.k: r for r in social.profiles(spark.createDataFrame(rows, "k int, html string"), "k").collect()}
    p = got[1]
    assert (p.status, p.name, p.website, p.phone, p.email, p.hours_status, p.address, p.price_range, p.confirmed_owner) == ("ok", "Joe & Co", "joe.com", "2", None, "Open now", "1 Main St", "$$", None)
    assert (p.categories, p.service_areas, [tuple(x) for x in p.social_links]) == (["Roofer"], ["A", "B"], [("youtube", "https://www.youtube.com/joe")])
    assert (p.recommend_percentage, p.review_count, p.reviews_url, p.followers_count, p.talking_about_count, p.checkins_count, p.bio) == (98, 12, "r", 1234, 7, None, "Since 1990.")
    assert [(got[k].status, got[k].phone, got[k].social_links) for k in (2, 4, 5)] == [("unavailable", None, [])] * 3
    assert (got[3].recommend_percentage, got[3].review_count, got[3].bio, got[3].categories) == (None, 4, None, [])
    flat = social.prefixed(social.profiles(spark.createDataFrame(rows[:1], "k int, html string"), "k"), "k").first()
    assert flat.facebook_service_areas == '["A","B"]' and flat.facebook_price_range == "$$"


def test_sinks(spark, tmp_path):
    one = spark.createDataFrame([(1, "a", ["x"])], "id int, name string, tags array<string>")
    two = spark.createDataFrame([(2,)], "id int")
    three = spark.createDataFrame([(3, "new, \"q\"")], "id int, extra string")
    path = str(tmp_path / "csv")
    for df in (one, two, three):
        writers.csv(df, path)
    back = versions.read(spark, path)
    assert sorted(back.columns) == ["extra", "id", "name", "tags"]
    assert sorted((r.id, r.name, r.extra, r.tags) for r in back.collect()) == [("1", "a", None, '["x"]'), ("2", None, None, None), ("3", None, 'new, "q"', None)]
    for df in (one, three):
        writers.parquet(df, str(tmp_path / "pq"))
    assert writers.read_evolved(spark, str(tmp_path / "pq")).columns == ["extra", "id", "name", "tags"]
    errors = writers.load(one, {"json": str(tmp_path / "json"), "null": "", "table": "not a name !"})
    assert set(errors) == {"table"} and spark.read.json(str(tmp_path / "json")).count() == 1
    with pytest.raises(ValueError):
        writers.load(one, {"nowhere": ""})
    assert writers.as_text(one, {"id": "Id", "name": "Name"}).first().value == "Id: 1\nName: a"
    capture.append(spark.createDataFrame([("k", "2024-01-01", "b"), ("k", "2024-01-01", "b")], "kind string, day string, body string"), str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "raw")).select("file_name").distinct().count() == 1


def test_streaming(spark, tmp_path, data):
    out, land = str(tmp_path / "out"), str(tmp_path / "in")
    rows = spark.createDataFrame([(1, "3056424409"), (2, "(305) 642-4409"), (3, "3050000000"), (4, None), (5, None)], "id int, phone string").withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows.coalesce(1).write.parquet(land)
    for _ in range(2):  # the second run finds all done
        stream = ingest.first_seen(ingest.landing(spark, land, rows.schema), "phone", "ts")
        ingest.into_table(stream, out, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(out).count() == 4 and spark.read.parquet(out).where("phone is null").count() == 2


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    land, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "id int, key string")
    rows.coalesce(1).write.parquet(land)
    ingest.into_table(ingest.landing(spark, land, rows.schema), out, ck).awaitTermination()
    for name in ("0", ".0.crc"):  # as if the run had ended before the batch was noted as done
        (tmp_path / "ck" / "commits" / name).unlink(missing_ok=True)
    ingest.into_table(ingest.landing(spark, land, rows.schema), out, ck).awaitTermination()
    assert sorted(map(str, spark.read.parquet(out).select("id", "key").collect())) == sorted(map(str, rows.collect()))


def test_a_new_checkpoint_adds_to_the_table(spark, tmp_path):
    land, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).coalesce(1).write.parquet(land)
    kind = spark.read.parquet(land).schema
    ingest.into_table(ingest.landing(spark, land, kind), out, str(tmp_path / "one")).awaitTermination()
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "in2"))
    ingest.into_table(ingest.landing(spark, str(tmp_path / "in2"), kind), out, str(tmp_path / "two")).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 13 and got.select("run").distinct().count() == 2
    last = ingest.newest(got.withColumn("n", F.col("run")), ["id"], "n").where("id = 0").first().n
    assert last == got.agg(F.max("run")).first()[0]


def test_checks_are_due_again_after_their_time(spark, tmp_path):
    """Three runs of one stream: fresh rows drop out, state expires, late and null rows; beside a plain pass over all rows."""
    hour = 3_600_000_000
    day0 = 1_700_000_000_000_000
    runs = [
        [("a", 0), ("a", 5), ("a", 10), ("b", 3), ("c", 1), (None, 2), ("d", None)],
        [("a", 11), ("a", 19), ("a", 20), ("b", 9), ("c", 200), ("c", 201)],
        [("b", 400), ("a", 399), ("a", 405), ("c", 409)],
    ]
    kind = "key string, us long"
    land = str(tmp_path / "in")
    for rows in runs:
        df = spark.createDataFrame([(k, None if h is None else day0 + h * hour) for k, h in rows], kind).select("key", F.timestamp_micros("us").alias("ts"))
        df.coalesce(1).write.mode("append").parquet(land)
        stream = ingest.landing(spark, land, df.schema)
        ingest.into_table(ingest.due(stream, "key", "ts", 10 * 3600, "10 days"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    last, want = {}, []
    for k, h in sorted((k, h) for rows in runs for k, h in rows if k is not None and h is not None):
        if k not in last or h - last[k] >= 10:
            last[k] = h
            want.append((k, h))
    got = [(r.key, (r.us - day0) // hour) for r in spark.read.parquet(str(tmp_path / "out")).select("key", F.unix_micros("ts").alias("us")).collect()]
    assert sorted(got) == want
    import numpy as np

    assert ingest.due_at(np.array([1, 2, 9, 11, 30]), None, 10) == [1, 11, 30] and ingest.due_at(np.array([1, 2, 9, 11, 30]), 5, 10) == [30] and ingest.due_at(np.array([3]), 5, 10) == []


def test_readers_see_whole_versions(spark, tmp_path):
    """A replacement that fails, a record that is half written, writers that meet, folders that go: readers see one version, and nothing is renamed."""
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    one = spark.createDataFrame([(1, "a\nb"), (2, None)], "id int, name string")
    versions.append(one, path)
    opened = versions.read(spark, path)

    def fails(old):
        return old.select(F.raise_error(F.lit("on purpose")).cast("string").alias("id"))

    with pytest.raises(Exception, match="on purpose"):
        versions.replaced(path, spark, fails)
    ids = lambda df: sorted(int(r.id) for r in df.collect())
    assert ids(versions.read(spark, path)) == [1, 2] and versions.current(spark, path).number == 1
    (tmp_path / "t" / "_versions" / "000000000002").write_text('{"format": "csv", "fol')  # a writer that died
    assert ids(versions.read(spark, path)) == [1, 2]
    with pytest.MonkeyPatch.context() as m:
        m.setattr(versions, "PATIENCE", 0.0)
        versions.append(spark.createDataFrame([(3, "x")], "id int, extra string"), path)
    assert versions.current(spark, path).number == 3 and versions.read(spark, path).columns == ["extra", "id", "name"]
    assert [r.name for r in versions.read(spark, path).where("id = 1").collect()] == ["a\nb"]

    calls = []

    def meets(old):  # another writer comes first, once
        calls.append(ids(old))
        if len(calls) == 1:
            versions.append(spark.createDataFrame([(4,)], "id int"), path)
        return old.where("id > 1")

    versions.replaced(path, spark, meets)
    assert calls == [[1, 2, 3], [1, 2, 3, 4]] and ids(versions.read(spark, path)) == [2, 3, 4]
    assert ids(opened) == [1, 2]  # a reader stays with its version
    versions.compacted(spark, path)
    assert ids(versions.read(spark, path)) == [2, 3, 4] and len(versions.current(spark, path).folders) == 1
    gone = versions.cleaned(spark, path, 1)
    assert gone and ids(versions.read(spark, path)) == [2, 3, 4] and len(list((tmp_path / "t").glob("data-*"))) == 1
    with pytest.raises(ValueError):
        versions.append(one, path, "parquet")


def test_row_order_of_many_files(spark, tmp_path):
    for i in range(40):
        header = "name,x" if i % 3 else "x,name"
        (tmp_path / f"f{i:02d}.csv").write_text("\n".join([header, *(f"{i},{k}" for k in range(5))]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = tables.listing_csv(spark, *[str(p) for p in tmp_path.glob("*.csv")]).orderBy("row_idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len({r.row_idx for r in got}) == 200
    assert [(r.name, r.x) if i // 5 % 3 else (r.x, r.name) for i, r in enumerate(got)] == [(str(i), str(k)) for i in range(40) for k in range(5)]


def test_rows_without_a_status_are_published_and_counted(spark):
    from leadmill.plans.bindings import MASTER, bound

    rows = bound(spark, "/root/testdata/sf0.001", MASTER).limit(2).withColumn("match_status", F.when(F.monotonically_increasing_id() > 0, "a_only"))
    _, counts = publish.published(rows, "2024-06-01", ["list_id"])
    got = counts.agg(*[F.sum(c).alias(c) for c in counts.columns if c != "list_id"]).first()
    assert sum(got) == 2


def test_profiles(spark):
    state = {"businessProfile": {"id": "0_77", "bbbId": "1", "businessId": "2", "names": {"primary": "A"}, "urls": {}, "contactInformation": {"phoneNumber": "3056424409", "contacts": [{"name": {"first": "X"}, "title": ""}, {"name": {"first": "P", "last": "Q"}, "title": "Owner", "isPrincipal": True}, {}]}, "display": {"socialMediaList": [{"type": "facebook", "url": "f"}, {"type": "x"}]}, "accreditationInformation": {"text": [{"customText": "ok"}, {}]}, "customerReviews": {"page": 1, "totalPages": 3, "items": [{"id": "r", "text": " it&#39;s ", "date": {"day": "9", "month": "2", "year": "2026"}}, {"id": "s", "date": {"day": "x"}}]}}}
    pages = spark.createDataFrame([(1, f"<script>window.__PRELOADED_STATE__ = {json.dumps(state)};</script>"), (2, "<html>"), (3, None)], "k long, html string")
    r = profiles.registry_details(pages).collect()
    assert len(r) == 1 and (r[0].listing_id, r[0].principal_contact, r[0].accreditation_status) == ("1_2_77", "P Q, Owner", "ok")
    assert [c.name for c in r[0].contacts] == ["X", "P Q"] and [s.url for s in r[0].socials] == ["f"]
    assert [(x.review_id, x.text, x.date, x.total_pages) for x in profiles.registry_reviews(pages).collect()] == [("r", "it's", "2026-02-09", 3), ("s", None, None, 3)]
    blob = 'z:["$","$L1",null,{"data-testid":"businessProfileHero","name":"N","phoneNumber":"$undefined","overallRating":"4.5","reviewCount":"$undefined","isPaidPro":true,"categories":[{"name":"c"},{}]}] "profileUrl":"/companylist/a" "profileUrl":"/companylist/b" "profileUrl":"/companylist/a" "resultCount":19,"limit":10,"page":1'
    pro = spark.createDataFrame([(f"<script>self.__next_f.push([1,{json.dumps(blob)}])</script>",), ("<p>",)], "html string").coalesce(1)
    rows = profiles.pros_details(pro.withColumn("u", F.lit(1))).collect()
    assert (rows[0].name, rows[0].phone, rows[0].overall_rating, rows[0].review_count, rows[0].is_paid_pro, rows[0].categories) == ("N", None, 4.5, None, True, ["c"]) and rows[1].name is None
    more = blob + ',null,{"subHeaderDescriptions":[{"subHeader":"Warranties","description":"Yes"}]},null,{"subHeaderDescriptions":[{"subHeader":"1 Main St, Elgin, IL 60120","description":"a.com","link":"x"}]},null,{"subHeaderDescriptions":[{"description":"About"}],"highlights":[{"typeId":3,"value":"v"},{"typeId":4},{}]},null,{"bonded":"Yes","insured":"$undefined","licenses":["L1",{"n":1}]},null,{"averageRating":4.1,"reviewCount":7,"distribution":[{"star":5,"count":2,"percentage":50.0},{"star":1}]},null,{"isShowVerifiedReview":true,"isShowRatings":true,"reviews":[{"text":" it&#39;s ","rating":5,"isVerified":true,"reviewerName":"$undefined"}]}'
    full = profiles.pros_details(spark.createDataFrame([(f"<script>self.__next_f.push([1,{json.dumps(more)}])</script>",)], "html string")).first()
    assert (full.review_count, full.website, full.street, full.city, full.zip_code, full.about_us, full.highlights) == (7, "a.com", "1 Main St", "Elgin", "60120", "About", ["typeId:3=v", "typeId:4"])
    assert (full.bonded, full.insured, full.licenses, [x.star for x in full.rating_breakdown]) == ("Yes", None, ["L1", '{"n":1}'], [5])
    assert [(x.text, x.rating, x.is_verified, x.reviewer_name) for x in full.reviews] == [("it's", 5.0, True, None)]
    first = profiles.pros_listing(pro).first()
    assert (first.profile_urls, first.result_count, first.page) == (["/companylist/a", "/companylist/b"], 19, 1)
    assert spark.range(1).select(profiles.facebook_url(profiles.socials_of(F.lit('[{"platform": "x", "url": "n"}, {"platform": "facebook", "url": "f"}]')))).first()[0] == "f"


def test_runs(spark, tmp_path):
    for name, body in (("roofing--b", "name,x\nB,1\n"), ("roofing--a", "name\nA\n"), ("hvac--a", "name\nZ\n")):
        (tmp_path / f"{name}.csv").write_text(body)
    got = tables.checkpoints(spark, str(tmp_path), "roofing").orderBy("row_idx").collect()
    assert [(r.name, r.x) for r in got] == [("A", None), ("B", "1")]
    with pytest.raises(FileNotFoundError):
        tables.checkpoints(spark, str(tmp_path), "none")
    lists = spark.createDataFrame([("a",), ("b",)], "metro string")
    assert [r.metro for r in tables.unfinished(lists, lists.where("metro = 'a'"), ["metro"]).collect()] == ["b"] and tables.unfinished(lists, lists, ["metro"], True).count() == 2
    rows, seen = browse.observed(lists, "run", first=F.col("metro") == "a")
    writers.null(rows)
    assert seen.get == {"rows": 2, "first": 1}
    sets = spark.createDataFrame([("i", "m", 1), ("i", "n", 2)], "industry string, metro string, k int")
    publish.write_datasets(sets, str(tmp_path / "sets"))
    publish.write_datasets(sets.where("metro = 'n'").withColumn("k", F.lit(9)), str(tmp_path / "sets"))
    assert sorted(r.k for r in spark.read.json(str(tmp_path / "sets")).collect()) == [1, 9]


def test_places_beyond_one_turn_of_longitudes_keep_their_own_answers(spark, tmp_path):
    """Places 360,000 apart had the same points around them, so each got the answers of both."""
    from leadmill.operators import coverage
    from leadmill.plans import captured

    keys = [k + turn for k in (1, 2, 3, 7) for turn in (0, 100_000, 360_000, 720_000)]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(str(tmp_path / "customer.parquet"))
    got = {(x.place, x.point, x.asked_page, x.listing_id) for x in coverage.ring_sweep(*captured._swept(spark, str(tmp_path)), 25.0, 5, 2).collect()}
    want = {(k, p, page, f"{k}-{p}-{page}") for k in keys for p in range(5) for page in (1, 2) if (p == 0 or (k + p) % 3) and (k + p) % 5}
    assert got == want


def test_profile_pages_of_one_file_are_dealt_over_tasks(spark):
    from leadmill.sources import profiles

    pages = spark.range(40).selectExpr("id", "concat('<p>', id, '</p>') as html").coalesce(1)
    got = profiles.pros_details(pages)
    assert got.count() == 40 and got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
