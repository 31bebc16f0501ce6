"""Public records, datasets and their manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text
from ..sinks import versions
from . import curation, scoring
from .dedupe import upsert

#: Public fields with a fallback in the second listing.
IDENTITY = {"name": "name", "phone": "phone", "city": "city", "state": "state", "postal_code": "zip_code", "website": "website", "address": "address", "profile_url": "profile_url"}
#: Fields that pass from the registry as they are, and those that it holds as JSON.
PLAIN = ("principal_contact", "email", "email_source", "accreditation_status", "business_started", "primary_category_name", "organization_description", "entity_type", "website_status")
DECODED = {
    "registry_categories": "array<string>", "registry_contacts": "array<struct<name: string, title: string, is_principal: boolean>>", "registry_socials": "array<struct<platform: string, url: string>>",
    "registry_reviews_complaints": "struct<reviews_total: double, average_rating: double, complaints_total: double>", "facebook_social_links": "array<struct<platform: string, url: string>>", "facebook_service_areas": "array<string>",
}
REVIEW = "array<struct<reviewer_name: string, rating: double, date: string, date_label: string, text: string>>"
#: Review columns by source, and how readers know the source.
REVIEWED = {"registry": "BBB", "mapquest": "Yelp", "angi": "Angi"}
FLAGS = ("on_angi", "website_dead_flag", "reputation_divergence_flag", "accredited_but_low_rated", "review_gap_flag", "has_phone", "has_named_contact", "has_email")
NUMBERS = ("lead_priority_score", "review_need_score", "rating_gap", "registry_grade_num", "registry_review_avg", "contact_readiness_score", "review_sentiment_signal")


def fallback(first: Column, second: Column) -> Column:
    """The first unless it is null or empty (a blank is a value)."""
    return F.when(F.coalesce(first, F.lit("")) != "", first).otherwise(second)


def specialties(a: Column, b: Column) -> Column:
    """Two lists as one, without repeats that differ only in case (the first spelling stays), joined by "; "."""
    words = F.filter(F.transform(F.concat(F.coalesce(a, F.array().cast("array<string>")), F.coalesce(b, F.array().cast("array<string>"))), lambda x: F.trim(x)), lambda x: x != "")
    lower = F.transform(words, lambda x: F.lower(x))
    return F.array_join(F.filter(words, lambda x, i: F.array_position(lower, F.lower(x)) == i + 1), "; ")


def social_links(rows: DataFrame, key: str, sources: list[str]) -> DataFrame:
    """(key, platform, url): the first source's link of each platform; `sources` are array<struct<platform, url>> columns in order."""
    parts = [rows.select(key, F.lit(i).alias("src"), F.posexplode(F.col(c)).alias("pos", "s")) for i, c in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select(key, F.col("s.platform").alias("platform"), F.col("s.url").alias("url"), "src", "pos").where("platform is not null and url is not null")
    return out.groupBy(key, "platform").agg(F.min_by("url", F.struct("src", "pos")).alias("url"))


def sources_count(*present: Column) -> Column:
    out = F.lit(0)
    for p in present:
        out = out + F.coalesce(p.cast("boolean"), F.lit(False)).cast("int")
    return out


def public(master: DataFrame) -> DataFrame:
    """What readers see of scored, curated master rows; columns the master lacks are null."""
    have = lambda c, kind="string": F.col(c).cast(kind) if c in master.columns else F.lit(None).cast(kind)
    out = [have("industry").alias("industry"), have("metro").alias("metro"), have("match_status").alias("match_status")]
    out += [fallback(have(f"registry_{k}"), have(f"angi_{v}")).alias(k) for k, v in IDENTITY.items()]
    out += [have("registry_rating").alias("grade"), text.truthy(have("registry_accredited")).alias("accredited"), text.whole(have("registry_years_in_business")).alias("years_in_business")]
    out += [dates.day_only(have("registry_scraped_at")).alias("scraped_on"), have("contact_readiness").alias("contact_readiness")]
    out += [have(f"registry_{k}").alias(k) for k in PLAIN] + [have(f"registry_{k}", "double").alias(k) for k in ("lat", "lon")]
    out += [text.decoded(have(c), kind).alias(c.removeprefix("registry_")) for c, kind in DECODED.items()]
    # The matched record's own figures, else those that the other door to the same site shows.
    matched = F.coalesce(F.col("match_status") == "matched", F.lit(False))
    other = F.coalesce(F.upper(F.trim(have("mapquest_rating_provider"))) == "YELP", F.lit(False))
    either = lambda one, two, kind: F.when(matched, have(one, kind)).when(other, have(two, kind))
    out += [(matched | other).alias("on_yelp"), (other & ~matched).alias("yelp_via_mapquest"), F.when(matched, have("yelp_name")).alias("yelp_name"), F.when(matched, have("yelp_price")).alias("yelp_price")]
    out += [either("yelp_rating", "mapquest_rating_value", "double").alias("yelp_rating"), either("yelp_review_count", "mapquest_review_count", "int").alias("yelp_review_count"), either("yelp_url", "mapquest_rating_url", "string").alias("yelp_url")]
    on_angi = F.coalesce(have("on_angi", "int"), F.lit(0)) == 1
    out += [F.when(on_angi, have(f"angi_{k}", t)).alias(f"angi_{k}") for k, t in (("name", "string"), ("overall_rating", "double"), ("review_count", "int"), ("profile_url", "string"))]
    out += [(on_angi & text.truthy(have("angi_is_super_service_award_winner"))).alias("angi_super_service_award"), specialties(text.decoded(have("registry_categories"), "array<string>"), F.split(have("angi_categories"), ";")).alias("specialties")]
    label = F.create_map(*[F.lit(x) for pair in REVIEWED.items() for x in pair])
    out += [have(c).alias(c) for c in ("top_complaint_theme", "top_complaint_summary", "most_recent_review_date", "most_recent_negative_review_date", "facebook_status", "facebook_price_range")]
    out += [F.try_element_at(label, have(c)).alias(c) for c in ("most_recent_review_source", "most_recent_negative_review_source")]
    out += [have(c, "double").alias(c) for c in ("review_sentiment_analyzed_count", "review_sentiment_negative_count", "facebook_recommend_percentage", "facebook_review_count")]
    out += [text.decoded(have(f"{k}_reviews"), REVIEW).alias(f"{k}_reviews") for k in REVIEWED]
    out += [have(k, "boolean").alias(k) for k in FLAGS] + [have(k, "double").alias(k) for k in NUMBERS]
    return master.select(*out)


def reviews_sheet(rows: DataFrame) -> DataFrame:
    """One row for every review of public records: business, city, source, reviewer, rating, date and text."""
    def of(column: str, source: str) -> Column:
        return F.transform(column, lambda r: F.struct(F.lit(source).alias("source"), r["reviewer_name"].alias("reviewer"), r["rating"].alias("rating"), F.coalesce(r["date"], r["date_label"]).alias("date"), r["text"].alias("text")))

    return rows.select(F.col("name").alias("business"), "city", F.inline(F.concat(*[of(f"{k}_reviews", name) for k, name in REVIEWED.items()])))


def leads_sheet(rows: DataFrame) -> DataFrame:
    """Public records with the number of reviews of each source in the place of the reviews."""
    return rows.withColumns({f"{k}_reviews": F.size(f"{k}_reviews") for k in REVIEWED})


def from_listings(rows: DataFrame, prefix: str = "registry_") -> DataFrame:
    """Raw listings as masters that only this source knows."""
    return rows.select(*[F.col(c).alias(c if c in ("industry", "metro", "list_id") else prefix + c) for c in rows.columns], F.lit("a_only").alias("match_status"))


def published(master: DataFrame, as_of: str, within: list[str]) -> tuple[DataFrame, DataFrame]:
    """(public rows, curation counts): scores anew, drops b_only rows (one without a status stays), curates, then projects."""
    scored = scoring.with_scores(master.where("not (match_status <=> 'b_only')"), as_of)
    marked = curation.reasons(scored, curation.name_key(), F.col("angi_is_corporate_account"), F.col("lead_priority_score"), within)
    return public(marked.where("drop_reason is null")), curation.counts(marked, within)


def manifest(rows: DataFrame, generated_at: str) -> DataFrame:
    """One entry for each dataset (industry, metro)."""
    g = rows.groupBy("industry", "metro").agg(F.count("*").alias("record_count"), F.bool_or(F.col("match_status") == "matched").alias("has_yelp"), F.count_if(F.col("match_status") == "matched").alias("yelp_matched"), F.round(F.coalesce(F.max("lead_priority_score"), F.lit(0.0)), 1).alias("top_lead_score"))
    name = F.concat(text.slug(F.col("industry")), F.lit("--"), text.slug(F.col("metro")))
    return g.withColumn("id", name).withColumn("file", F.concat("id", F.lit(".json"))).withColumn("published_at", F.lit(generated_at))


def manifest_upsert(old: DataFrame, entries: DataFrame) -> DataFrame:
    return upsert(old, entries, ["id"]).orderBy("metro", "industry")


def write_manifest(entries: DataFrame, path: str) -> None:
    """Put the entries into the manifest at path; readers (`versions.read`) see the old manifest or the new one, whole."""
    versions.replaced(path, entries.sparkSession, lambda old: manifest_upsert(old, entries) if old is not None else entries, "parquet")


def stitched(manifest_rows: DataFrame, datasets: DataFrame) -> DataFrame:
    """Dataset rows with industry and metro of their manifest entry; entries without a dataset drop out."""
    return datasets.drop("industry", "metro").join(manifest_rows.select("id", "industry", "metro"), "id")


def write_datasets(rows: DataFrame, path: str) -> None:
    """JSON lines by industry and metro; only the lists that are written again are replaced."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("industry", "metro").json(path)
