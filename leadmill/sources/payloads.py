"""Captured JSON answers of listing sources as rows.  Input tables have a `body` column and whatever identifies a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators.dedupe import first_of

LISTING_PAGE = """struct<page: int, pageSize: int, totalPages: int, totalResults: int, location: struct<latLng: string>,
 results: array<struct<id: string, businessId: string, officeId: string, businessName: string, address: string, city: string, state: string,
 postalcode: string, phone: array<string>, location: string, rating: string, ratingScore: double, member: boolean, reportUrl: string, localReportUrl: string,
 categories: array<struct<id: string, name: string>>>>>"""
LOCAL_SEARCH = """struct<total: int, businesses: array<struct<id: string, name: string, phone: string, display_phone: string, rating: double, review_count: int, price: string,
 is_closed: boolean, url: string, categories: array<struct<alias: string, title: string>>, coordinates: struct<latitude: double, longitude: double>,
 location: struct<address1: string, city: string, state: string, zip_code: string>>>>"""
MAP_SEARCH = """struct<data: struct<search: struct<nodes: array<struct<id: string, name: string, url: string, phone: string,
 location: struct<street: string, region: string, postcode: string, locality: string>, rating: struct<provider: string, value: double, url: string>,
 reviews: struct<totalCount: int, nodes: array<struct<body: string, rating: double, date: string, title: string, author: struct<name: string>>>>>>>>>"""


def lat_lon(c: Column) -> tuple[Column, Column]:
    """Of a "lat,lon" text; null if either is missing or no number."""
    p = F.split(c, ",", 2)
    lat, lon = text.number(F.trim(F.get(p, 0))), text.number(F.trim(F.get(p, 1)))
    both = lat.isNotNull() & lon.isNotNull()
    return F.when(both, lat), F.when(both, lon)


def listing_pages(pages: DataFrame) -> DataFrame:
    """One row a listing of registry search pages; items without an id or a name are left out, pages that aren't JSON give none."""
    keys = [c for c in pages.columns if c != "body"]
    rows = pages.select(*keys, F.from_json("body", LISTING_PAGE).alias("p")).select(*keys, F.col("p.page").alias("page"), F.posexplode("p.results").alias("pos", "r"))
    lat, lon = lat_lon(F.col("r.location"))
    return rows.where("r.id is not null and r.businessName is not null").select(
        *keys, "page", "pos", F.col("r.id").alias("listing_id"), F.col("r.businessId").alias("business_id"), F.col("r.officeId").alias("office_id"),
        text.squashed(F.col("r.businessName")).alias("name"), text.squashed(F.col("r.address")).alias("address"), text.squashed(F.col("r.city")).alias("city"), F.col("r.state").alias("state"),
        F.col("r.postalcode").alias("postal_code"), text.phone_display(F.get("r.phone", 0)).alias("phone"), F.slice("r.phone", 2, 1_000_000).alias("other_phones"),
        lat.alias("lat"), lon.alias("lon"), F.col("r.rating").alias("rating"), F.col("r.ratingScore").alias("rating_score"), F.col("r.member").alias("accredited"),
        F.coalesce("r.localReportUrl", "r.reportUrl").alias("profile_url"), F.transform("r.categories", lambda c: c["name"]).alias("categories"),
    )


def listing_counts(pages: DataFrame) -> DataFrame:
    """Items of every registry search page: all, kept by `listing_pages`, and skipped; a page that isn't JSON has none, and says so."""
    keys = [c for c in pages.columns if c != "body"]
    p = pages.select(*keys, F.from_json("body", LISTING_PAGE).alias("p"), F.try_parse_json("body").isNotNull().alias("readable"))
    items = F.coalesce("p.results", F.array().cast(p.schema["p"].dataType["results"].dataType))
    kept = F.size(F.filter(items, lambda r: r["id"].isNotNull() & r["businessName"].isNotNull()))
    return p.select(*keys, "readable", F.size(items).alias("items"), kept.alias("kept"), (F.size(items) - kept).alias("skipped"))


def page_centers(pages: DataFrame) -> DataFrame:
    """The centre that a search page answered for, and how many results its paging can reach."""
    keys = [c for c in pages.columns if c != "body"]
    p = pages.select(*keys, F.from_json("body", LISTING_PAGE).alias("p"))
    lat, lon = lat_lon(F.col("p.location.latLng"))
    return p.select(*keys, lat.alias("lat"), lon.alias("lon"), (F.col("p.pageSize") * F.col("p.totalPages")).alias("reachable"), F.col("p.totalResults").alias("total"))


def local_search(pages: DataFrame, page: str = "page") -> DataFrame:
    """Businesses of local-search answers in the shape of linkage; each id once: its first place over all pages."""
    rows = pages.select(page, F.posexplode(F.from_json("body", LOCAL_SEARCH)["businesses"]).alias("pos", "b")).where("b.id is not null and b.name is not null")
    rows = first_of(rows.withColumn("id", F.col("b.id")), [F.col("id")], [F.col(page), F.col("pos")])
    return rows.select(
        page, "pos", "id", F.col("b.name").alias("name"), F.coalesce(F.nullif("b.phone", F.lit("")), "b.display_phone").alias("phone"), F.col("b.location.zip_code").alias("postal"),
        F.col("b.location.city").alias("city"), F.col("b.location.state").alias("state"), F.col("b.coordinates.latitude").alias("lat"), F.col("b.coordinates.longitude").alias("lon"),
        F.col("b.rating").alias("rating"), F.col("b.review_count").alias("review_count"), F.col("b.price").alias("price"), F.col("b.is_closed").alias("is_closed"), F.col("b.url").alias("url"),
        F.array_join(F.transform("b.categories", lambda c: c["title"]), "; ").alias("categories"),
    )


def map_search(pages: DataFrame, key: str = "query_id") -> DataFrame:
    """Candidates of map-search answers; nodes without an id are left out and review ratings (0-10) are halved."""
    rows = pages.select(key, F.posexplode(F.from_json("body", MAP_SEARCH)["data"]["search"]["nodes"]).alias("cand_idx", "n")).where("n.id is not null")
    reviews = F.transform("n.reviews.nodes", lambda r: F.struct(r["body"].alias("text"), (r["rating"] / 2).alias("rating"), r["date"].alias("date"), r["author"]["name"].alias("reviewer_name"), r["title"].alias("title")))
    return rows.select(
        key, F.col("cand_idx").cast("long").alias("cand_idx"), F.col("n.id").alias("mapquest_id"), F.col("n.name").alias("name"), F.col("n.phone").alias("phone"), F.col("n.url").alias("url"),
        F.coalesce("n.reviews.totalCount", F.lit(0)).alias("review_count"), F.greatest(F.coalesce(F.size("n.reviews.nodes"), F.lit(0)), F.lit(0), F.coalesce("n.reviews.totalCount", F.lit(0))).alias("reviews"),
        reviews.alias("review_list"), F.col("n.rating.provider").alias("rating_provider"), F.col("n.rating.value").alias("rating_value"),
    )


def cache_key(path: Column, params: Column) -> Column:
    """Of a request: its path and its parameters in the order of their names."""
    pairs = F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.sha2(F.concat(path, F.lit("?"), F.array_join(pairs, "&")), 256)


def detail_rows(details: DataFrame) -> DataFrame:
    """Professional profiles as flat rows: star shares as columns, lists joined by "; ", reviews as JSON."""
    stars = F.map_from_entries("rating_breakdown")
    lists = {c: F.array_join(c, "; ") for c in ("categories", "licenses", "highlights") if c in details.columns}
    return details.withColumns({
        **{f"rating_{k}_star_pct": F.try_element_at(stars, F.lit(k)) for k in (5, 4, 3, 2, 1)}, "num_categories": F.size("categories"),
        "num_reviews_captured": F.size("reviews"), "overall_rating": F.round("overall_rating", 2),
    }).withColumns(lists).withColumn("reviews", F.to_json("reviews")).drop("rating_breakdown")
