"""Enrichment of master rows by what look-ups have found: websites, map search, social profiles, review texts, sentiment.

Look-ups happen outside, where the network is; their answers are captured tables.  A step asks for its open rows alone, reads their answers, and leaves
all others as they are, so a second run redoes only what is still open.  What a row knows is a cell with three states: null or blank is open (it
could not be asked for, or has no answer yet), "[]" was asked for and nothing fits, and JSON is what was found.

Masters have a unique row_id.  Cells and columns that a master lacks are open.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import enrich, lookup, publish, reviews
from ..session import kept
from ..sources import payloads, profiles, social

#: The columns of each step: the first is the cell that says what is known.
MAP = {"mapquest_reviews": "string", "mapquest_url": "string", "mapquest_review_count": "double", "mapquest_rating_provider": "string", "mapquest_rating_value": "double"}
SENTIMENT = {
    "review_sentiment_analyzed_count": "long", "review_sentiment_negative_count": "long", "most_recent_review_date": "date", "most_recent_review_source": "string", "most_recent_negative_review_date": "date",
    "most_recent_negative_review_source": "string", "avg_review_gap_days": "double", "top_complaint_theme": "string", "top_complaint_summary": "string",
}
SOCIAL = {
    "facebook_status": "string", "facebook_address": "string", "facebook_phone": "string", "facebook_email": "string", "facebook_hours_status": "string", "facebook_recommend_percentage": "int", "facebook_review_count": "int",
    "facebook_reviews_url": "string", "facebook_confirmed_owner": "string", "facebook_name": "string", "facebook_website": "string", "facebook_categories": "string", "facebook_service_areas": "string", "facebook_price_range": "string",
    "facebook_social_links": "string", "facebook_followers_count": "int", "facebook_talking_about_count": "int", "facebook_checkins_count": "int", "facebook_bio": "string",
}
#: Review columns by source.
REVIEWED = {"registry": "registry_reviews", "mapquest": "mapquest_reviews", "angi": "angi_reviews"}
OPEN, NONE, FOUND = "open", "none", "found"


def cell_state(c: Column) -> Column:
    """open, none or found."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(t == "", OPEN).when(t == "[]", NONE).otherwise(FOUND)


def completed(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows with every column, null where they lack it."""
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in rows.columns})


def filled(rows: DataFrame, open_: Column, found: DataFrame, columns: dict[str, str]) -> DataFrame:
    """rows whose open ones take the columns of found (row_id, ...); an open row that nothing was found for keeps what it has."""
    other = found.select(F.col("row_id").alias("__id"), F.lit(True).alias("__found"), *[F.col(c).cast(t).alias(f"__{c}") for c, t in columns.items()])
    j = rows.join(other, F.col("row_id") == F.col("__id"), "left")
    takes = open_ & F.col("__found").isNotNull()
    return j.withColumns({c: F.when(takes, F.col(f"__{c}")).otherwise(F.col(c)) for c in columns}).select(*rows.columns)


@dataclass(frozen=True)
class Step:
    """asked: (row_id, key) of the rows that a look-up could answer now, by the key of the look-up.  run: the rows with what the answers say."""

    name: str
    asked: Callable[[DataFrame], DataFrame]
    run: Callable[[DataFrame], DataFrame]


def sites(answers: DataFrame, as_of: str, ttl_days: float = 14.0, field: str = "registry_website") -> Step:
    """Website checks; answers (url, code, body, error, checked_at), of which those younger than ttl_days count.  Rows without a site need none."""
    dead, status, checked = urls.check_columns(field)
    columns = {dead: "boolean", status: "string", checked: "string"}

    def stale(rows: DataFrame) -> Column:
        age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col(checked).try_cast("timestamp"))) / 86400.0
        return F.col(status).isNull() | (text.has_value(F.col(field)) & F.coalesce(age >= ttl_days, F.lit(True)))

    def asked(rows: DataFrame) -> DataFrame:
        rows = completed(rows, columns)
        return rows.where(stale(rows) & text.has_value(F.col(field))).select("row_id", urls.normalized(F.col(field)).alias("key"))

    def run(rows: DataFrame) -> DataFrame:
        rows = completed(rows, columns)
        known = enrich.fresh(answers, "checked_at", ttl_days, as_of).select(urls.normalized(F.col("url")).alias("key"), "code", "body", "error", F.col("checked_at").cast("string").alias("at"))
        known = known.groupBy("key").agg(F.max(F.struct("at", "code", "error", "body")).alias("a"))  # the latest answer of a site
        told = urls.site_status(F.col("key"), F.col("a.code"), F.col("a.body"), F.col("a.error"))
        found = asked(rows).join(known, "key").select("row_id", urls.is_dead(told).alias(dead), told.alias(status), F.col("a.at").alias(checked))
        none = rows.where(stale(rows) & ~text.has_value(F.col(field))).select("row_id", F.lit(False).alias(dead), F.lit("no_website").alias(status), F.lit(None).cast("string").alias(checked))
        return filled(rows, stale(rows), found.unionByName(none), columns)

    return Step("sites", asked, run)


def map_request(name: Column, lat: Column, lon: Column) -> Column:
    """The key of a map search."""
    place = F.format_string("%.5f,%.5f", lat, lon)
    return payloads.cache_key(F.lit("/search"), F.create_map(F.lit("query"), name, F.lit("location"), place))


def map_search(answers: DataFrame, cities: DataFrame, similarity=text.name_similarity) -> Step:
    """Map search by name at the business's city; answers (request, body).  A row is searched where it has a name and a city that is known."""
    first = lambda k: F.trim(publish.fallback(F.col(f"registry_{k}"), F.col(f"angi_{k}")))
    given = {f"{s}_{k}": "string" for s in ("registry", "angi") for k in ("name", "phone", "city", "state")}

    def who(rows: DataFrame) -> DataFrame:
        rows = completed(completed(rows, MAP), given)
        own = rows.where(cell_state(F.col("mapquest_reviews")) == OPEN).select("row_id", *[first(k).alias(k) for k in ("name", "phone", "city", "state")]).where("name <> ''")
        return lookup.city(own, cities).where("lat is not null").withColumn("key", map_request(F.col("name"), F.col("lat"), F.col("lon")))

    def asked(rows: DataFrame) -> DataFrame:
        return who(rows).select("row_id", "key")

    def run(rows: DataFrame) -> DataFrame:
        own = who(rows)
        known = answers.groupBy(F.col("request").alias("key")).agg(F.max("body").alias("body"))
        found = payloads.map_search(known, "key").withColumn("reviews", F.greatest("review_count", F.size("review_list").cast("int")))
        met = own.select("row_id", "key").join(found, "key")
        picks = enrich.picked(own.select(F.col("row_id").alias("query_id"), "name", "phone"), met.select(F.col("row_id").alias("query_id"), "cand_idx", "name", "phone", "reviews"), similarity)
        best = picks.where("cand_idx is not null").select(F.col("query_id").alias("row_id"), "cand_idx").join(met, ["row_id", "cand_idx"])
        best = best.select("row_id", F.to_json("review_list").alias("mapquest_reviews"), F.col("url").alias("mapquest_url"), F.col("review_count").alias("mapquest_review_count"), F.col("rating_provider").alias("mapquest_rating_provider"), F.col("rating_value").alias("mapquest_rating_value"))
        answered = own.join(known.where(F.try_parse_json("body").isNotNull()).select("key"), "key").select("row_id")
        searched = answered.join(best.drop("mapquest_reviews"), "row_id", "left").join(best.select("row_id", "mapquest_reviews"), "row_id", "left").withColumn("mapquest_reviews", F.coalesce("mapquest_reviews", F.lit("[]")))
        rows = completed(rows, MAP)
        return filled(rows, cell_state(F.col("mapquest_reviews")) == OPEN, searched, MAP)

    return Step("map_search", asked, run)


def social_profiles(answers: DataFrame, socials: str = "registry_socials") -> Step:
    """Social profiles of the rows with a link; answers (url, html), html null where the page could not be read, which is tried again."""
    columns = SOCIAL | {"registry_email": "string", "registry_email_source": "string"}
    open_ = F.coalesce(F.col("facebook_status"), F.lit("check_failed")) == "check_failed"

    def linked(rows: DataFrame) -> DataFrame:
        rows = completed(completed(rows, columns), {socials: "string"})
        return rows.where(open_).select("row_id", profiles.facebook_url(profiles.socials_of(F.col(socials))).alias("key"))

    def asked(rows: DataFrame) -> DataFrame:
        return linked(rows).where("key is not null")

    def run(rows: DataFrame) -> DataFrame:
        want = linked(rows)
        pages = answers.groupBy(F.col("url").alias("key")).agg(F.max("html").alias("html"))  # a page that was read goes before one that was not
        read = social.prefixed(social.profiles(pages.where("html is not null"), "key"), "key")
        got = want.join(read, "key").drop("key")
        failed = want.join(pages.where("html is null").select("key"), "key").select("row_id", F.lit("check_failed").alias("facebook_status"))
        none = want.where("key is null").select("row_id", F.lit("no_facebook_link").alias("facebook_status"))
        found = completed(got, SOCIAL).unionByName(completed(failed.unionByName(none), SOCIAL), allowMissingColumns=True)
        rows = completed(rows, columns)
        return profiles_backfilled(filled(rows, open_, found, SOCIAL))

    return Step("social_profiles", asked, run)


def profiles_backfilled(rows: DataFrame) -> DataFrame:
    """The e-mail of a social profile where the registry has none; where it came from stays once it is said."""
    before = F.col("registry_email_source")
    back = profiles.email_backfilled(rows.withColumn("__source", before))
    return back.withColumn("registry_email_source", F.coalesce("__source", "registry_email_source")).drop("__source")


def review_texts(answers: DataFrame, most: int = 50) -> Step:
    """Review texts of the rows worth it; answers (profile_url, html) are the pages of reviews, in any number for a profile."""
    columns = {"registry_reviews": "string", "registry_num_reviews_captured": "int"}
    given = {"registry_profile_url": "string", "reviews_total": "int"}

    def asked(rows: DataFrame) -> DataFrame:
        rows = completed(completed(rows, columns), given)
        worth = enrich.worth_reading(rows.where(cell_state(F.col("registry_reviews")) == OPEN), "reviews_total", "registry_profile_url")
        return worth.select("row_id", F.trim("registry_profile_url").alias("key"))

    def run(rows: DataFrame) -> DataFrame:
        said = profiles.registry_reviews(answers.select(F.trim("profile_url").alias("key"), "html"))
        said = said.withColumn("pos", F.col("page") * 1_000_000 + F.col("pos")).dropDuplicates(["key", "pos"])
        item = F.struct("review_id", "reviewer_name", "rating", "text", "date")
        one = reviews.first_per_business(said, "key", most).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("pos", item.alias("i")))).alias("p"))
        one = one.select("key", F.transform("p", lambda x: x["i"]).alias("r"))
        answered = answers.select(F.trim("profile_url").alias("key")).distinct()  # a profile without reviews is answered as well
        found = asked(rows).join(answered, "key").join(one, "key", "left").select("row_id", F.coalesce(F.to_json("r"), F.lit("[]")).alias("registry_reviews"), F.coalesce(F.size("r"), F.lit(0)).alias("registry_num_reviews_captured"))
        rows = completed(rows, columns)
        return filled(rows, cell_state(F.col("registry_reviews")) == OPEN, found, columns)

    return Step("review_texts", asked, run)


def sentiment(cache: DataFrame, analyse: Callable[[pd.DataFrame], pd.DataFrame] | None = None) -> Step:
    """Sentiment of all review texts of rows that have some and no counts yet: from the cache, or by `analyse`, each distinct text once.

    A row is done when every one of its texts has an analysis; until then it is open."""

    def texts(rows: DataFrame) -> DataFrame:
        rows = completed(completed(rows, SENTIMENT), dict.fromkeys(REVIEWED.values(), "string"))
        some = rows.where(F.col("review_sentiment_analyzed_count").isNull() & reviews.has_any(*REVIEWED.values()))
        return reviews.opened(some, "row_id", REVIEWED)

    def asked(rows: DataFrame) -> DataFrame:
        return texts(rows).select("row_id", F.col("text_hash").alias("key"))

    def run(rows: DataFrame) -> DataFrame:
        said = texts(rows)
        known = reviews.analysed(said, cache, analyse) if analyse else cache
        known = known.select("source", "text_hash", "sentiment", "severity", "theme", "summary", "actionable")
        joined = said.join(known, ["source", "text_hash"], "left")
        whole = joined.groupBy("row_id").agg(F.bool_and(F.col("sentiment").isNotNull()).alias("all")).where("all").select("row_id")
        found = reviews.rollup(joined.join(whole, "row_id", "left_semi"), "row_id")
        rows = completed(rows, SENTIMENT)
        return filled(rows, F.col("review_sentiment_analyzed_count").isNull(), found, SENTIMENT)

    return Step("sentiment", asked, run)


def applied(rows: DataFrame, steps: list[Step], keep: Callable[[DataFrame], DataFrame] = kept) -> DataFrame:
    """All steps, one after the other; `keep` writes what a step leaves: a step reads its rows several times, and a failure later costs only the
    steps behind it."""
    for step in steps:
        rows = keep(step.run(rows))
    return rows


def work_list(rows: DataFrame, steps: list[Step]) -> DataFrame:
    """(step, key, rows): what has to be looked up now, each key once, and how many rows wait for it."""
    out = None
    for step in steps:
        one = step.asked(rows).groupBy(F.lit(step.name).alias("step"), "key").agg(F.count("*").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out
