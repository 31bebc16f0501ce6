"""Sweeps of captured searches around places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo
from ..sources import payloads


def anchor_text(lat, lon):
    """How a search names a point: degrees with five decimals."""
    return F.format_string("%.5f,%.5f", lat, lon)


def reached(pages: DataFrame, most: int) -> DataFrame:
    """Captured pages (query, asked_page, body) up to `most` of a query that paging gets to: it ends behind the first page without a listing."""
    some = pages.where(F.col("asked_page").between(1, most))
    filled = payloads.listing_counts(some).select("query", "asked_page", (F.col("kept") > 0).cast("int").alias("filled"))
    before = F.coalesce(F.sum("filled").over(W.partitionBy("query").orderBy("asked_page").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    open_ = filled.withColumn("before", before).where("before = asked_page - 1").select("query", "asked_page")
    return some.join(open_, ["query", "asked_page"], "left_semi")


def anchors(places: DataFrame, pages: DataFrame, radius: float, points: int) -> DataFrame:
    """(place, point, query) of the searches of every place (place, query): itself as point 0, and the rings around the centre that its first
    page names; without a centre, itself alone."""
    first = pages.where("asked_page = 1").select("query", "body")
    centers = places.join(payloads.page_centers(first).select("query", "lat", "lon"), "query").where("lat is not null")
    ring = geo.coverage_points(centers, radius, points).where("point > 0")
    own = places.select("place", F.lit(0).alias("point"), "query")
    return own.unionByName(ring.select("place", F.col("point").cast("int").alias("point"), anchor_text(F.col("point_lat"), F.col("point_lon")).alias("query")))


def ring_sweep(places: DataFrame, pages: DataFrame, radius: float = 25.0, points: int = 16, most_pages: int = 2) -> DataFrame:
    """The listings of all searches around each place: place, point, asked_page and the columns of `payloads.listing_pages`.

    pages are captured answers (query, asked_page, body), each once; places are (place, query).  The pool is not de-duplicated: what lies near several
    anchors comes with each of them.  Anchors that nobody searched give no rows.
    """
    found = payloads.listing_pages(reached(pages, most_pages).select("query", "asked_page", "body"))
    return anchors(places, pages, radius, points).join(found, "query")
