"""Social profile pages: what the meta tags say, and the cards that lie anywhere in a page's JSON.

A card is an object with a kind and a renderer.  Where it lies differs from page to page, so the JSON of the page's scripts is walked:
`parse_json` gives variants, and a recursive query takes their children level by level, with their place.  Only what still holds the word
of a card goes on, so each level is smaller than the one before.  Everything runs on the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .markup import bare_website, dot_list, platform

#: The key that makes an object a card, and the kinds of card.
KIND = "timeline_context_list_item_type"
CARDS = {
    "categories": "INTRO_CARD_INFLUENCER_CATEGORY", "address": "INTRO_CARD_ADDRESS", "phone": "INTRO_CARD_PROFILE_PHONE", "email": "INTRO_CARD_PROFILE_EMAIL",
    "website": "INTRO_CARD_WEBSITE", "hours_status": "INTRO_CARD_BUSINESS_HOURS", "confirmed_owner": "INTRO_CARD_CONFIRMED_OWNER_LABEL",
    "price_range": "INTRO_CARD_BUSINESS_PRICE", "service_areas": "INTRO_CARD_BUSINESS_SERVICE_AREA", "rating": "INTRO_CARD_RATING", "account": "INTRO_CARD_OTHER_ACCOUNT",
}
#: What the counts of a description are followed by.
COUNTED = {"followers_count": "followers?", "talking_about_count": "talking about this", "checkins_count": "were here"}
#: Nesting that the JSON parser itself allows.
LEVELS = 1000
SCRIPT = r"(?is)<script\b[^>]*>(.*?)</script\s*>"

_WALK = f"""with recursive walk(page, place, node) max recursion level {LEVELS} as (
 select page, array(script), node from {{scripts}}
 union all
 select w.page, concat(w.place, array(c.pos)), c.value from walk w, lateral variant_explode(w.node) c where contains(to_json(c.value), '"{KIND}"'))
select page, place, try_variant_get(node, '$.{KIND}', 'string') as kind, try_variant_get(node, '$.renderer.context_item', 'variant') as item
from walk where try_variant_get(node, '$.{KIND}', 'string') is not null and try_variant_get(node, '$.renderer', 'variant') is not null limit all"""


def cards(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """(page, place, kind, item): the cards of every page; place orders them, by script, level by level (the keys of one object by name).

    Scripts that are no JSON, or nest deeper than the parser allows, hold no cards.
    """
    found = pages.select(F.col(page).alias("page"), F.posexplode(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1))).alias("script", "body"))
    found = found.where(F.contains("body", F.lit(f'"{KIND}"'))).select("page", "script", F.try_parse_json(F.trim("body")).alias("node")).where("node is not null")
    return pages.sparkSession.sql(_WALK, scripts=found)


def _text(item: Column) -> Column:
    """The title's text, or the plain title's where there is none; blank is null."""
    title = F.try_variant_get(item, "$.title", "variant")
    has = title.isNotNull() & ~F.coalesce(F.to_json(title), F.lit("null")).isin("{}", "null")
    return text.blank_to_null(F.when(has, F.try_variant_get(item, "$.title.text", "string")).otherwise(F.try_variant_get(item, "$.plaintext_title.text", "string")))


def _meta(html: Column, name: str) -> Column:
    found = F.regexp_extract_all(html, F.lit(rf'(?i)<meta\s+(?:property|name)="{name}"\s+content="([^"]*)"'), F.lit(1))
    return text.entities_plain(F.get(found, 0))


def _whole(c: Column, pattern: str) -> Column:
    return text.whole(F.nullif(F.replace(F.regexp_extract(c, pattern, 1), F.lit(","), F.lit("")), F.lit("")))


def described(about: Column) -> list[Column]:
    """The counts of a description, each for itself, and what follows the sentence of counts."""
    counts = [_whole(about, rf"(?i)([\d,]+)\s+{words}").alias(name) for name, words in COUNTED.items()]
    one = rf"[\d,]+\s+(?:{'|'.join(COUNTED.values())})\s*(?:·\s*)?"
    bio = text.blank_to_null(F.regexp_extract(about, rf"(?s)^[^.]*\.\s*(?:{one})+\.(.*)$", 1))
    return [*counts, bio.alias("bio")]


def profiles(pages: DataFrame, page: str, html: str = "html") -> DataFrame:
    """One row for every page: status, name, the cards' fields and the description's counts.

    A page without a title is "unavailable", and all else of it is null or empty.  Of several cards of a kind the last one counts, of websites the
    first.  A rating without a share ("not yet rated") still has its number of reviews.  Pages are known by the column `page`: of rows
    that share it one stays.
    """
    found = cards(pages, page, html).select("page", "place", "kind", _text(F.col("item")).alias("said"), "item").where("said is not null")
    is_ = lambda name: F.col("kind") == CARDS[name]
    last = lambda name, what: F.max_by(what, F.when(is_(name), F.col("place")))
    reviews = _whole(F.col("said"), r"(?i)\((\d+) *reviews?\)")
    share = _whole(F.col("said"), r"(?i)(\d+)% *recommend *\(")
    rated = is_("rating") & reviews.isNotNull() & (share.isNotNull() | F.lower("said").like("%not yet rated%"))
    link = F.get(F.filter(F.transform(F.try_variant_get("item", "$.title.ranges", "array<variant>"), lambda r: F.try_variant_get(r, "$.entity.external_url", "string")), lambda u: u != ""), 0)
    account = F.when(is_("account") & link.isNotNull(), F.struct("place", F.struct(platform(link).alias("platform"), link.alias("url")).alias("link")))
    kept = ("categories", "address", "phone", "email", "hours_status", "confirmed_owner", "price_range", "service_areas")
    rows = found.groupBy("page").agg(
        *[last(c, "said").alias(c) for c in kept], F.min_by("said", F.when(is_("website"), F.col("place"))).alias("website"),
        F.max_by(share, F.when(rated, F.col("place"))).alias("recommend_percentage"), F.max_by(reviews, F.when(rated, F.col("place"))).alias("review_count"),
        last("rating", F.try_variant_get("item", "$.url", "string")).alias("reviews_url"), F.transform(F.array_sort(F.collect_list(account)), lambda x: x["link"]).alias("social_links"),
    )
    metas = pages.dropDuplicates([page]).select(F.col(page), _meta(F.col(html), "og:title").alias("title"), _meta(F.col(html), "og:description").alias("about"))
    open_ = F.coalesce(F.col("title") != "", F.lit(False))
    price = dot_list(F.col("price_range"))
    out = metas.join(rows, metas[page].eqNullSafe(rows["page"]), "left").drop("page")
    fields = {c: F.col(c) for c in ("address", "phone", "email", "hours_status", "recommend_percentage", "review_count", "reviews_url", "confirmed_owner")}
    fields |= {
        "name": text.blank_to_null(F.substring_index("title", " | ", 1)), "website": bare_website(F.col("website")), "categories": dot_list(F.col("categories")), "service_areas": dot_list(F.col("service_areas")),
        "price_range": F.when(F.size(price) > 0, F.element_at(price, -1)).otherwise(F.col("price_range")), "social_links": F.col("social_links"),
    }
    fields |= {name: c for name, c in zip([*COUNTED, "bio"], described(F.col("about")), strict=True)}
    lists = {"categories": "array<string>", "service_areas": "array<string>", "social_links": "array<struct<platform: string, url: string>>"}
    shown = [F.coalesce(F.when(open_, c), F.array().cast(lists[k])).alias(k) if k in lists else F.when(open_, c).alias(k) for k, c in fields.items()]
    return out.select(page, F.when(open_, "ok").otherwise("unavailable").alias("status"), *shown)


def prefixed(profile: DataFrame, page: str, prefix: str = "facebook_") -> DataFrame:
    """Profiles as columns of a master: lists as JSON, each name behind the prefix."""
    return profile.select(page, *[(F.to_json(c) if t.startswith("array") else F.col(c)).alias(prefix + c) for c, t in profile.dtypes if c != page])
