"""Queries of captured pages, files and sinks: each makes its captures or files of the driver's tables, then reads them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, geo, text, urls
from ..operators import browse, coverage, lookup, publish, reviews
from ..session import shared_dir
from ..sinks import versions, writers
from ..sources import capture, markup, payloads, profiles, tables
from . import lifecycle, steps
from .bindings import A, B, CITIES, REVIEWS, bound, plain
from .queries import query

a, b, cities, said = plain(A), plain(B), plain(CITIES), plain(REVIEWS)


def _place(s: SparkSession, name: str) -> str:
    return f"{shared_dir(s)}/leadmill/{name}-{uuid.uuid4().hex}"


def _flight(blob: Column) -> Column:
    """A page that streams the blob."""
    quoted = F.to_json(F.array(blob))
    return F.concat(F.lit("<script>self.__next_f.push([1,"), F.substr(quoted, F.lit(2), F.length(quoted) - 2), F.lit("])</script>"))


# --- reference tables and files -----------------------------------------------------------------------------------
def _array_file(s: SparkSession, rows: DataFrame, name: str) -> str:
    path = _place(s, name)
    rows.agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")).coalesce(1).write.text(path)
    return path


@query("category_table", "select cast(n_nationkey as varchar) as id, n_name as name, lower(n_name) as slug from nation")
def _(s, d):
    return tables.categories(s, _array_file(s, bound(s, d, "select cast(n_nationkey as string) as id, n_name as name, lower(n_name) as slug from {nation}"), "categories"))


@query("metro_table", "select cast(n_nationkey as varchar) as id, n_name as name, n_name || ', TX' as seed_location from nation")
def _(s, d):
    return tables.metros(s, _array_file(s, bound(s, d, "select cast(n_nationkey as string) as id, n_name as name, concat(n_name, ', TX') as seed_location from {nation}"), "metros"))


@query("city_table", f"select name, state, lat, lon, cast(population as int) as population, geoid from ({cities})")
def _(s, d):
    path = _place(s, "cities")
    bad = F.when(F.col("geoid") == "none", F.lit("x")).otherwise(F.col("lat").cast("string")).alias("lat")
    bound(s, d, CITIES).unionByName(s.sql("select 'Bad' as name, 'S0' as state, 0.0d as lat, 0.0d as lon, 0L as population, 'none' as geoid")).select("name", "state", bad, "lon", "population", "geoid").write.csv(path, header=True)
    return tables.cities(s, path)


@query("gazetteer_table", "select cast(n_nationkey as varchar) as geoid, n_name || ' ñ town' as name from nation")
def _(s, d):
    path = _place(s, "gazetteer")
    n = bound(s, d, "select concat(' ', cast(n_nationkey as string)) as GEOID, concat(n_name, ' ñ town  ') as `NAME  ` from {nation}")
    n.write.option("sep", "|").option("encoding", "ISO-8859-1").option("ignoreTrailingWhiteSpace", False).option("ignoreLeadingWhiteSpace", False).csv(path, header=True)
    return tables.gazetteer(s, path)


@query("listing_files", f"select cast(idx as varchar) as idx, name, phone, city from (select idx, name, phone, case when list_id > 1 then city end as city from ({a}))")
def _(s, d):
    """Files of two headers in one table."""
    rows, path = bound(s, d, A), _place(s, "listings")
    rows.where("list_id > 1").select("idx", "name", "city", "phone").write.option("escape", '"').csv(f"{path}/one", header=True)
    rows.where("list_id <= 1").select("phone", "name", "idx").write.option("escape", '"').csv(f"{path}/two", header=True)
    return tables.listing_csv(s, f"{path}/one", f"{path}/two").select("idx", "name", "phone", "city")


@query("checkpoint_files", f"select cast(idx as varchar) as idx, name, phone, cast(list_id as varchar) as list_id from ({a}) where list_id < 3")
def _(s, d):
    """The finished list files of one industry, by their names; those of another industry stay out."""
    rows, path = bound(s, d, A).select("idx", "name", "phone", "list_id"), _place(s, "checkpoints")
    for k, name in ((0, "roofing--a"), (1, "roofing--b"), (2, "roofing--c"), (3, "hvac--a")):
        rows.where(f"list_id = {k}").write.option("escape", '"').csv(f"{path}/{name}.csv", header=True)
    return tables.checkpoints(s, path, "roofing").select("idx", "name", "phone", "list_id")


@query("unfinished_lists", "select c_mktsegment, c_nationkey from (select distinct c_mktsegment, c_nationkey from customer) where c_nationkey % 3 > 0")
def _(s, d):
    lists = s.read.parquet(f"{d}/customer.parquet").select("c_mktsegment", "c_nationkey").distinct()
    return tables.unfinished(lists, lists.where("c_nationkey % 3 = 0"), ["c_mktsegment", "c_nationkey"])


@query("csv_evolution", "select cast(p_partkey as varchar) as id, case when p_partkey % 2 = 0 then p_name end as name, case when p_partkey % 2 = 1 then p_brand end as extra from part")
def _(s, d):
    """Appended rows with a new column; readers then see the columns of both."""
    p, path = s.read.parquet(f"{d}/part.parquet"), _place(s, "evolved")
    writers.csv(p.where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), path)
    writers.csv(p.where("p_partkey % 2 = 1").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("extra")), path)
    return versions.read(s, path).select("id", "name", "extra")


@query("manifest_replaced", "select n_name as id, row_number() over (order by metro, industry) - 1 as position, cast(case when n_nationkey % 3 = 0 then n_nationkey + 1000 else n_nationkey end as bigint) as record_count from (select *, 'M' || n_regionkey as metro, 'I' || n_nationkey as industry from nation where n_nationkey % 3 = 0 or n_nationkey % 2 = 0)")
def _(s, d):
    """A manifest written twice: the second run's entries replace those of the same id; entries are ordered by metro and industry."""
    n, path = s.read.parquet(f"{d}/nation.parquet"), _place(s, "manifest")
    entry = lambda count: [F.col("n_name").alias("id"), F.concat(F.lit("M"), F.col("n_regionkey")).alias("metro"), F.concat(F.lit("I"), F.col("n_nationkey")).alias("industry"), count.cast("long").alias("record_count")]
    publish.write_manifest(n.where("n_nationkey % 2 = 0").select(*entry(F.col("n_nationkey"))), path)
    publish.write_manifest(n.where("n_nationkey % 3 = 0").select(*entry(F.col("n_nationkey") + 1000)), path)
    return browse.ranked(versions.read(s, path), ["metro", "industry"]).select("id", "position", "record_count")


@query("sinks_by_name", "select p_partkey as id, p_name as name, '[\"' || p_brand || '\"]' as tags from part union all select p_partkey, p_name, null from part")
def _(s, d):
    """The same rows through two sinks: JSON lines, and Parquet of two shapes read as one."""
    p, path = s.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.array("p_brand").alias("tags")), _place(s, "sinks")
    errors = writers.load(p.drop("tags"), {"json": f"{path}/json", "null": ""}) | writers.load(p, {"parquet": f"{path}/parquet"})
    if errors:
        raise ValueError(str(errors))
    return writers.flattened(writers.read_evolved(s, f"{path}/parquet")).select("id", "name", "tags").unionByName(s.read.json(f"{path}/json").select("id", "name", F.lit(None).cast("string").alias("tags")))


@query("text_export", "select 'Id: ' || p_partkey || case when p_size > 25 then chr(10) || 'Name: ' || p_name else '' end as value from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_name")).otherwise("").alias("name"))
    return writers.as_text(p, {"p_partkey": "Id", "name": "Name"})


# --- captured answers ---------------------------------------------------------------------------------------------
@query("page_centers", f"select list_id, 20.5::double + list_id as lat, -80.25::double as lon, cast(15 * n as int) as reachable, cast(n * 100 as int) as total from (select list_id, count(*) as n from ({a}) group by 1)")
def _(s, d):
    n = bound(s, d, A).groupBy("list_id").agg(F.count("*").cast("int").alias("n"))
    where = F.struct(F.concat((F.col("list_id") + 20.5).cast("string"), F.lit(",-80.25")).alias("latLng"))
    page = F.struct(F.lit(1).alias("page"), F.lit(15).alias("pageSize"), F.col("n").alias("totalPages"), (F.col("n") * 100).alias("totalResults"), where.alias("location"))
    return payloads.page_centers(n.select("list_id", F.to_json(page).alias("body")))


def _swept(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Every customer is a place; searches of it and of the points around its centre, some of them without a centre, some anchors without an answer.

    Page 2 follows page 1 everywhere, but page 1 of every fifth anchor holds no usable listing."""
    k = F.col("place")
    places = s.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").cast("long").alias("place"), F.concat(F.lit("Place "), F.col("c_custkey").cast("string")).alias("query"))
    # No two places share a point, however many there are: an answer is captured once for a query, and longitudes that go on would come round.
    lat, lon = F.round(25 + (k % 20) + F.floor(k / 100_000) / 1000, 3), F.round(-80 - (k % 100_000) / 1000, 3)
    at = F.when(k % 4 > 0, F.concat(lat.cast("string"), F.lit(","), lon.cast("string")))
    around = geo.coverage_points(places.where("place % 4 > 0").withColumns({"lat": lat, "lon": lon}), 25.0, 5).where("point > 0 and (place + point) % 3 > 0")
    asked = places.select("place", F.lit(0).alias("point"), "query").unionByName(around.select("place", "point", coverage.anchor_text(F.col("point_lat"), F.col("point_lon")).alias("query")))
    asked = asked.withColumn("asked_page", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))).withColumn("usable", ((k + F.col("point")) % 5 > 0) | (F.col("asked_page") > 1))
    name = F.concat_ws("-", k.cast("string"), F.col("point").cast("string"), F.col("asked_page").cast("string"))
    items = F.array(F.struct(F.when(F.col("usable"), name).alias("id"), F.lit("N").alias("businessName")), F.struct(F.lit(None).cast("string").alias("id"), F.lit("no id").alias("businessName")))
    body = F.to_json(F.struct(F.col("asked_page").alias("page"), F.struct(F.when(F.col("point") == 0, at).alias("latLng")).alias("location"), items.alias("results")))
    return places, asked.select("query", "asked_page", body.alias("body"))


@query("ring_sweep", """with p as (select c_custkey as place, unnest(range(5)) as point from customer), a as (select place, cast(point as int) as point, unnest([1, 2]) as asked_page from p where point = 0 or (place % 4 > 0 and (place + point) % 3 > 0))
 select place, point, asked_page, place || '-' || point || '-' || asked_page as listing_id from a where (place + point) % 5 > 0""")
def _(s, d):
    return coverage.ring_sweep(*_swept(s, d), 25.0, 5, 2).select("place", "point", "asked_page", "listing_id")


@query("skipped_items", """with p as (select c_custkey as place, unnest(range(5)) as point from customer), a as (select place, cast(point as int) as point, unnest([1, 2, 3]) as asked_page from p where point = 0 or (place % 4 > 0 and (place + point) % 3 > 0))
 select cast(asked_page as int) as asked_page, count(*) as pages, cast(2 * count(*) as bigint) as items, cast(sum(case when asked_page = 1 and (place + point) % 5 = 0 then 2 else 1 end) as bigint) as skipped from a group by 1""")
def _(s, d):
    counts = payloads.listing_counts(_swept(s, d)[1]).where("readable")
    return counts.groupBy("asked_page").agg(F.count("*").alias("pages"), F.sum("items").alias("items"), F.sum("skipped").alias("skipped"))


@query("local_search", f"select idx, name, phone, rating, page from (select *, cast(idx // 15 as bigint) as page, row_number() over (partition by idx order by idx) as k from ({b})) where k = 1")
def _(s, d):
    """Every business stands on two pages; its place on the first one counts."""
    at = F.floor(F.col("idx") / 15)
    r = bound(s, d, B).withColumn("page", F.explode(F.array(at, at + 1_000_000_000)))
    item = F.struct(F.col("idx").cast("string").alias("id"), "name", F.lit("").alias("phone"), F.col("phone").alias("display_phone"), "rating")
    pages = r.groupBy("page").agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("idx", item.alias("i")))), lambda x: x["i"]).alias("businesses"))).alias("body"))
    return payloads.local_search(pages).select(F.col("id").cast("long").alias("idx"), "name", "phone", "rating", "page")


@query("map_search", f"select list_id * 1000000 + idx // 15 as query_id, idx as mapquest_id, name, review_count, rating / 2 as first_rating from ({b}) where idx % 4 > 0")
def _(s, d):
    review = F.struct(F.lit("t").alias("body"), "rating")
    node = F.struct(F.when(F.col("idx") % 4 > 0, F.col("idx").cast("string")).alias("id"), "name", F.struct(F.col("review_count").alias("totalCount"), F.array(review).alias("nodes")).alias("reviews"))
    pages = bound(s, d, B).groupBy((F.col("list_id") * 1_000_000 + F.floor(F.col("idx") / 15)).alias("query_id")).agg(F.to_json(F.struct(F.struct(F.struct(F.collect_list(node).alias("nodes")).alias("search")).alias("data"))).alias("body"))
    return payloads.map_search(pages).select("query_id", F.col("mapquest_id").cast("long").alias("mapquest_id"), "name", F.col("review_count").cast("long").alias("review_count"), F.col("review_list")[0]["rating"].alias("first_rating"))


@query("detail_rows", "select p_partkey, p_type || '; ' || p_brand as categories, cast(p_size as double) as rating_5_star_pct, null::double as rating_3_star_pct, cast(2 as int) as num_categories, cast(1 as int) as num_reviews_captured, '[{\"text\":\"' || p_name || '\"}]' as reviews from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    stars = F.array(F.struct(F.lit(5).alias("k"), F.col("p_size").cast("double").alias("v")), F.struct(F.lit(1).alias("k"), F.lit(2.0).alias("v")))
    rows = p.select("p_partkey", stars.alias("rating_breakdown"), F.array("p_type", "p_brand").alias("categories"), F.array(F.struct(F.col("p_name").alias("text"))).alias("reviews"), F.lit(4.567).alias("overall_rating"))
    return payloads.detail_rows(rows).select("p_partkey", "categories", "rating_5_star_pct", "rating_3_star_pct", "num_categories", "num_reviews_captured", "reviews")


@query("cache_key", "select p_partkey, sha256('/find?limit=' || p_size || '&term=' || p_brand) as key from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", payloads.cache_key(F.lit("/find"), F.create_map(F.lit("term"), F.col("p_brand"), F.lit("limit"), F.col("p_size").cast("string"))).alias("key"))


@query("capture_keys", "select page_id, sha256(html) as content_hash, 'page-' || substr(sha256(html), 1, 16) as file_name from pages")
def _(s, d):
    return capture.keyed(s.read.parquet(f"{d}/pages.parquet").select("page_id", F.col("html").alias("body"), F.lit("page").alias("kind"))).select("page_id", "content_hash", "file_name")


# --- profile pages ------------------------------------------------------------------------------------------------
@query("registry_reviews", "select conv_id, cast(turn as varchar) as review_id, role as reviewer_name, nullif(trim(text), '') as text, case when turn % 2 = 0 then '2024-03-' || lpad(cast(turn + 1 as varchar), 2, '0') end as date, cast(3 as int) as total_pages from conversations")
def _(s, d):
    c = s.read.parquet(f"{d}/conversations.parquet")
    day = F.struct(F.when(F.col("turn") % 2 == 0, (F.col("turn") + 1).cast("string")).alias("day"), F.lit("3").alias("month"), F.lit("2024").alias("year"))
    item = F.struct(F.col("turn").cast("string").alias("id"), F.col("role").alias("displayName"), "text", day.alias("date"))
    state = F.struct(F.struct(F.struct(F.lit(1).alias("page"), F.lit(3).alias("totalPages"), F.col("items")).alias("customerReviews")).alias("businessProfile"))
    pages = c.groupBy("conv_id").agg(F.collect_list(item).alias("items")).select("conv_id", F.concat(F.lit("<script>window.__PRELOADED_STATE__ = "), F.to_json(state), F.lit(";</script>")).alias("html"))
    return profiles.registry_reviews(pages).select("conv_id", "review_id", "reviewer_name", "text", "date", "total_pages")


@query("pros_listing", "select p_partkey, '/companylist/' || p_partkey || ' /companylist/z' as urls, cast(p_size as int) as result_count, cast(10 as int) as page_size, cast(2 as int) as page from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    one = F.concat(F.lit('"profileUrl":"/companylist/'), F.col("p_partkey").cast("string"), F.lit('" '))
    blob = F.concat(one, F.lit('"profileUrl":"/companylist/z" '), one, F.lit('"resultCount":'), F.col("p_size").cast("string"), F.lit(',"limit":10,"page":2'))
    got = profiles.pros_listing(p.select("p_partkey", _flight(blob).alias("html")))
    return got.select("p_partkey", F.array_join("profile_urls", " ").alias("urls"), "result_count", "page_size", "page")


@query("pros_details", "select p_partkey, p_name as name, case when p_partkey % 2 = 0 then cast(p_size as double) / 10 end as overall_rating, p_partkey % 3 = 0 as is_paid_pro, p_type as categories, p_partkey || ' Main St' as street, '60120' as zip_code, 'ok ' || p_size as about_us, 'Yes' as bonded, 'r ' || p_partkey as review from part")
def _(s, d):
    k, obj = F.col("p_partkey"), lambda *c: F.concat(F.lit(",null,"), F.to_json(F.struct(*c)))
    hero = obj(F.lit("businessProfileHero").alias("data-testid"), F.col("p_name").alias("name"), F.when(k % 2 == 0, (F.col("p_size") / 10).cast("string")).otherwise("$undefined").alias("overallRating"), (k % 3 == 0).alias("isPaidPro"), F.array(F.struct(F.col("p_type").alias("name"))).alias("categories"))
    plain_ = obj(F.array(F.struct(F.lit("Warranties").alias("subHeader"), F.lit("Yes").alias("description"))).alias("subHeaderDescriptions"))
    at = obj(F.array(F.struct(F.concat(k.cast("string"), F.lit(" Main St, Elgin, IL 60120")).alias("subHeader"), F.lit("a.com").alias("description"), F.lit("x").alias("link"))).alias("subHeaderDescriptions"))
    about = obj(F.array(F.struct(F.concat(F.lit("ok "), F.col("p_size").cast("string")).alias("description"))).alias("subHeaderDescriptions"), F.array(F.struct(F.lit("3").alias("typeId"))).alias("highlights"))
    licensing = obj(F.lit("Yes").alias("bonded"), F.array(F.lit("L")).alias("licenses"))
    read = obj(F.lit(True).alias("isShowVerifiedReview"), F.lit(True).alias("isShowRatings"), F.array(F.struct(F.concat(F.lit(" r "), k.cast("string")).alias("text"))).alias("reviews"))
    got = profiles.pros_details(s.read.parquet(f"{d}/part.parquet").select("p_partkey", _flight(F.concat(hero, plain_, at, about, licensing, read)).alias("html")))
    return got.select("p_partkey", "name", "overall_rating", "is_paid_pro", F.array_join("categories", ";").alias("categories"), "street", "zip_code", "about_us", "bonded", F.col("reviews")[0]["text"].alias("review"))


@query("hub_links", "select distinct 'n' || n_nationkey as slug, n_name as name from nation")
def _(s, d):
    link = lambda slug, name: F.concat(F.lit('<li><a class="c" href="'), slug, F.lit('">'), name, F.lit("</a></li>"))
    key = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    n = s.read.parquet(f"{d}/nation.parquet").select(F.concat(link(F.concat(key, F.lit(".htm")), F.col("n_name")), link(F.concat(F.lit("/x/"), key, F.lit(".htm")), F.lit("no")), link(F.concat(key, F.lit(".htm")), F.lit(" "))).alias("html"))
    return markup.hub_links(n)


@query("contact_list", "select p_partkey, case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then 'Pat ' || p_size else 'Pat' end as name, cast(case when p_partkey % 3 = 0 then 0 else 1 end as int) as n from part")
def _(s, d):
    k = F.col("p_partkey") % 3
    no = F.lit(None).cast("boolean")
    one = F.struct(F.struct(F.when(k > 0, "Pat").alias("first"), F.when(k == 1, F.col("p_size").cast("string")).otherwise("").alias("last")).alias("name"), F.lit("").alias("title"), no.alias("isPrincipal"), no.alias("isManagement"), no.alias("isPrimary"))
    c = s.read.parquet(f"{d}/part.parquet").select("p_partkey", profiles.contacts(F.array(one)).alias("c"))
    return c.select("p_partkey", F.get("c", 0)["name"].alias("name"), F.size("c").alias("n"))


@query("facebook_link", "select p_partkey, case when p_partkey % 2 = 0 then 'f' || p_partkey end as url from part")
def _(s, d):
    k = F.col("p_partkey").cast("string")
    cell = F.concat(F.lit('[{"platform": "x", "url": "n"}, {"platform": "facebook", "url": "'), F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("f"), k)).otherwise(""), F.lit('"}]'))
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", profiles.facebook_url(profiles.socials_of(cell)).alias("url"))


# --- enrichment steps ---------------------------------------------------------------------------------------------
def _to_enrich(s: SparkSession, d: str) -> tuple[DataFrame, list[steps.Step]]:
    """Every customer as a master row, and answers to some of what the steps ask."""
    rows = bound(s, d, """select c_custkey as row_id, concat('Shop', cast(c_custkey as string), ' Roofing') as registry_name, concat('305', lpad(cast(c_custkey as string), 7, '0')) as registry_phone,
     case when c_custkey % 6 > 0 then concat('Town ', cast(c_nationkey as string)) end as registry_city, 'tx' as registry_state, case when c_custkey % 9 > 0 then concat('shop', cast(c_custkey as string), '.com') end as registry_website,
     case when c_custkey % 4 > 0 then concat('[{{"platform": "facebook", "url": "https://f/', cast(c_custkey as string), '"}}]') end as registry_socials, concat('p', cast(c_custkey as string)) as registry_profile_url, cast(c_custkey % 3 as int) as reviews_total from {customer}""")
    towns = bound(s, d, "select concat('Town ', cast(n_nationkey as string)) as name, 'TX' as state, 25.0d + n_nationkey as lat, -80.0d as lon, 1000 as population, cast(n_nationkey as string) as geoid from {nation}")
    k, n = F.col("row_id"), F.col("row_id").cast("string")
    sites = rows.where(k % 5 > 0).select(F.concat(F.lit("https://shop"), n, F.lit(".com")).alias("url"), F.when(k % 3 == 0, 404).otherwise(200).alias("code"), F.lit("x").alias("body"), F.lit(None).cast("string").alias("error"), F.lit("2024-05-30 00:00:00").alias("checked_at"))
    review = F.struct(F.concat(F.lit("map "), n).alias("body"), F.lit(8.0).alias("rating"))
    node = F.struct(n.alias("id"), F.col("registry_name").alias("name"), F.when(k % 2 == 0, F.col("registry_phone")).otherwise("9990000000").alias("phone"), F.struct(F.lit(1).alias("totalCount"), F.array(review).alias("nodes")).alias("reviews"))
    placed = lookup.city(rows.where(k % 7 > 0), towns, "registry_city", "registry_state").where("lat is not null")
    maps = placed.select(steps.map_request(F.col("registry_name"), F.col("lat"), F.col("lon")).alias("request"), F.to_json(F.struct(F.struct(F.struct(F.array(node).alias("nodes")).alias("search")).alias("data"))).alias("body"))
    html = F.when(k % 8 == 2, "<html>log in</html>").when(k % 8 != 1, F.concat(F.lit('<meta property="og:title" content="S'), n, F.lit('">')))
    pages = rows.where(k % 8 != 3).select(F.concat(F.lit("https://f/"), n).alias("url"), html.alias("html"))
    item = lambda word, day: F.struct(F.concat(F.lit(word), n).alias("id"), F.concat(F.lit(f"{word} "), n).alias("text"), F.struct(F.lit("2024").alias("year"), F.lit("3").alias("month"), F.lit(day).alias("day")).alias("date"))
    state = F.struct(F.struct(F.struct(F.lit(1).alias("page"), F.lit(1).alias("totalPages"), F.array(item("good", "1"), item("bad", "2")).alias("items")).alias("customerReviews")).alias("businessProfile"))
    read = rows.where(k % 2 == 1).select(F.col("registry_profile_url").alias("profile_url"), F.concat(F.lit("<script>window.__PRELOADED_STATE__ = "), F.to_json(state), F.lit(";</script>")).alias("html"))
    known = F.explode(F.array(*[F.struct(F.lit(a).alias("source"), F.concat(F.lit(f"{w} "), n).alias("text"), F.lit(c).alias("sentiment")) for a, w, c in (("registry", "good", "positive"), ("registry", "bad", "negative"), ("mapquest", "map", "neutral"))]))
    cache = rows.where(k % 10 > 0).select(known.alias("c")).select("c.source", text.text_hash(F.col("c.text")).alias("text_hash"), "c.sentiment", F.lit(2).alias("severity"), F.lit("t").alias("theme"), F.lit("s").alias("summary"), F.lit(True).alias("actionable"))
    return rows, [steps.sites(sites, "2024-06-01"), steps.map_search(maps, towns, text.token_similarity), steps.social_profiles(pages), steps.review_texts(read), steps.sentiment(cache)]


_K = "(select c_custkey as k from customer)"


@query("enriched_master", f"""select k as row_id, case when k % 9 = 0 then 'no_website' when k % 5 = 0 then null when k % 3 = 0 then 'dead_404' else 'ok' end as website_status,
 case when k % 6 = 0 or k % 7 = 0 then 'open' when k % 2 = 0 then 'found' else 'none' end as map_state, case when k % 4 = 0 then 'no_facebook_link' when k % 8 = 1 then 'check_failed' when k % 8 = 2 then 'unavailable' when k % 8 = 3 then null else 'ok' end as facebook_status,
 case when k % 3 = 2 and k % 2 = 1 then cast(2 as int) end as reviews_captured, case when k % 3 = 2 and k % 2 = 1 then cast(2 as bigint) when k % 2 = 0 and k % 6 > 0 and k % 7 > 0 and k % 10 > 0 then cast(1 as bigint) end as analyzed,
 case when k % 3 = 2 and k % 2 = 1 then cast(1 as bigint) when k % 2 = 0 and k % 6 > 0 and k % 7 > 0 and k % 10 > 0 then cast(0 as bigint) end as negative from {_K}""")
def _(s, d):
    """All enrichment steps over a master; what has no answer stays open."""
    rows, _ = lifecycle.enriched(*_to_enrich(s, d))
    return rows.select("row_id", F.col("registry_website_status").alias("website_status"), steps.cell_state(F.col("mapquest_reviews")).alias("map_state"), "facebook_status", F.col("registry_num_reviews_captured").alias("reviews_captured"), F.col("review_sentiment_analyzed_count").alias("analyzed"), F.col("review_sentiment_negative_count").alias("negative"))


@query("work_still_open", f"""select 'sites' as step, count(*) as keys from {_K} where k % 9 > 0 and k % 5 = 0 union all select 'map_search', count(*) from {_K} where k % 6 > 0 and k % 7 = 0
 union all select 'social_profiles', count(*) from {_K} where k % 8 in (1, 3) union all select 'review_texts', count(*) from {_K} where k % 3 = 2 and k % 2 = 0
 union all select 'sentiment', count(*) from {_K} where k % 2 = 0 and k % 6 > 0 and k % 7 > 0 and k % 10 = 0""")
def _(s, d):
    """What a second run would look up: only what the first one has left open."""
    return lifecycle.enriched(*_to_enrich(s, d))[1].groupBy("step").agg(F.count("*").alias("keys"))


# --- functions and lists ------------------------------------------------------------------------------------------
@query("date_texts", "select event_id, case when event_id % 5 > 0 then '2024-' || lpad(cast(event_id % 20 as varchar), 2, '0') || '-' || lpad(cast(event_id % 40 as varchar), 2, '0') end as day, strftime(ts, '%Y-%m-%d') as day_only from events")
def _(s, d):
    k = F.col("event_id").cast("int")
    day = dates.date_text(F.when(k % 5 > 0, F.lit(2024)), k % 20, k % 40)
    return s.read.parquet(f"{d}/events.parquet").select("event_id", day.alias("day"), dates.day_only(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("day_only"))


@query("entity_texts", "select p_partkey, '<' || p_name || '> & \"x\" ' || chr(39) as t, case when p_partkey % 3 > 0 then p_name end as v from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    sentinel = F.when(F.col("p_partkey") % 3 > 0, F.concat(F.lit(" "), "p_name")).when(F.col("p_partkey") % 2 == 0, " $undefined ").otherwise("-")
    return p.select("p_partkey", text.entities_plain(F.concat(F.lit("&lt;"), "p_name", F.lit("&gt; &amp; &quot;x&quot; &#39;"))).alias("t"), text.sentinel_to_null(sentinel).alias("v"))


@query("connection_reasons", "select n_nationkey, case n_nationkey % 5 when 0 then 'DNS lookup failed' when 1 then 'connection timed out' when 2 then 'TLS/certificate error' when 3 then 'connection refused' else 'connection failed' end as reason from nation")
def _(s, d):
    said_ = F.element_at(F.array(*map(F.lit, ("Could not resolve host: x", "operation TIMED OUT after 5 s", "bad Certificate", "Connection reset by peer", "what?"))), (F.col("n_nationkey") % 5 + 1).cast("int"))
    return s.read.parquet(f"{d}/nation.parquet").select("n_nationkey", urls.connection_error(said_).alias("reason"))


@query("has_reviews", "select p_partkey, p_partkey % 4 > 1 as has from part")
def _(s, d):
    cell = F.element_at(F.array(F.lit(None).cast("string"), F.lit(" []"), F.lit("[1]"), F.lit("[2]")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return s.read.parquet(f"{d}/part.parquet").select("p_partkey", cell.alias("one"), F.lit("").alias("two")).select("p_partkey", reviews.has_any("one", "two").alias("has"))


@query("review_cap", f"select business, pos from (select business, pos, row_number() over (partition by business order by pos) as k from ({said})) where k <= 3")
def _(s, d):
    return reviews.first_per_business(bound(s, d, REVIEWS), "business", 3).select("business", "pos")


@query("sources_count", "select p_partkey, cast(1 + cast(p_size > 10 as int) + cast(p_size > 30 as int) as int) as n from part")
def _(s, d):
    p = s.read.parquet(f"{d}/part.parquet")
    return p.select("p_partkey", publish.sources_count(F.lit(1), F.col("p_size") > 10, F.when(F.col("p_size") > 30, 1)).alias("n"))


@query("sort_keys", "select p_partkey, coalesce(case when p_size > 40 then p_size::double end, case when p_size > 20 then -1.0::double end, 0.5::double) as rating, cast(cast(p_size > 10 as int) + 1 as int) as flags, cast(2 as int) as sources from part")
def _(s, d):
    size, one = F.col("p_size"), F.lit(1)
    rows = s.read.parquet(f"{d}/part.parquet").select(
        "p_partkey", F.when(size > 40, size.cast("double")).alias("yelp_rating"), F.when(size > 20, -1.0).alias("angi_rating"), F.lit(0.5).alias("registry_review_avg"), F.lit(None).cast("string").alias("most_recent_negative_review_date"),
        F.lit("2024").alias("most_recent_review_date"), (size > 10).alias("reputation_divergence_flag"), F.lit(None).cast("boolean").alias("accredited_but_low_rated"), one.alias("website_dead_flag"), F.lit(0).alias("review_gap_flag"), F.lit("1").alias("on_registry"), F.lit(True).alias("on_yelp"), F.lit(0).alias("on_angi"),
    )
    keys = browse.sort_keys()
    return rows.select("p_partkey", *[keys[k].alias(k) for k in ("rating", "flags", "sources")])


@query("stitched", "select c_custkey, c_mktsegment as industry, 'M' || c_nationkey as metro from customer where c_nationkey % 4 > 0")
def _(s, d):
    """Rows of datasets with industry and metro of their manifest entry; a dataset that the manifest lacks drops out."""
    c = bound(s, d, "select c_custkey, concat(c_mktsegment, cast(c_nationkey as string)) as id, c_mktsegment as industry, concat('M', cast(c_nationkey as string)) as metro, c_nationkey from {customer}")
    return publish.stitched(c.where("c_nationkey % 4 > 0").select("id", "industry", "metro").distinct(), c.select("c_custkey", "id")).select("c_custkey", "industry", "metro")


@query("status_counts", "select status, n, cast(sum(case when status like 'dead%' then n else 0 end) over () as bigint) as dead from (select case when page_id % 3 = 0 then 'dead_404' when page_id % 3 = 1 then 'ok' else 'dead_parked' end as status, count(*) as n from pages group by 1)")
def _(s, d):
    k = F.col("page_id") % 3
    p = s.read.parquet(f"{d}/pages.parquet").select(F.when(k == 0, "dead_404").when(k == 1, "ok").otherwise("dead_parked").alias("status"))
    return browse.status_counts(p)
