"""Derived columns of master rows and the lead score: one registry of name -> expression.

Sources are column prefixes: registry_ (the listing with letter grades, complaints and accreditation), yelp_, angi_,
mapquest_, facebook_.  Columns that a master lacks count as null.  A value that can't be computed is null and never
fails a row.  "Now" is an argument.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, grades, text

# Limits and weights of the scores.
MIN_REVIEWS, LOW_VOLUME, FULL_VOLUME = 5, 25, 150
SOURCE_WEIGHTS = {"yelp": 0.30, "angi": 0.25, "sentiment": 0.25, "registry": 0.20, "facebook": 0.10}
BONUS = {"reputation_divergence_flag": 12, "accredited_but_low_rated": 8, "review_gap_flag": 6}
TENURE_YEARS, TENURE_BONUS, ACCREDITED_BONUS, CONTACT_BONUS, NO_PHONE, TOP = 10, 6, 4, 5, 0.5, 130.0
RECENCY = ((180, 1.15), (365, 1.0), (730, 0.85))

COMPLAINTS = T.StructType([T.StructField("reviews_total", T.IntegerType()), T.StructField("average_rating", T.DoubleType()), T.StructField("complaints_total", T.IntegerType()), T.StructField("complaints_closed_past_3yr", T.IntegerType()), T.StructField("complaints_closed_past_12mo", T.IntegerType())])
INPUTS = {
    "match_status": "string", "registry_rating": "string", "registry_accredited": "string", "registry_phone": "string", "registry_email": "string",
    "registry_principal_contact": "string", "registry_years_in_business": "double", "website_dead": "string", "yelp_rating": "double", "yelp_review_count": "double",
    "angi_name": "string", "angi_phone": "string", "angi_overall_rating": "double", "angi_review_count": "double", "angi_is_corporate_account": "string",
    "mapquest_rating_provider": "string", "mapquest_rating_value": "double", "mapquest_review_count": "double", "facebook_status": "string",
    "facebook_recommend_percentage": "double", "facebook_review_count": "double", "review_sentiment_analyzed_count": "double", "review_sentiment_negative_count": "double",
    "most_recent_review_date": "date", "avg_review_gap_days": "double", "reviews_total": "int", "review_average": "double", "complaints_total": "int",
}


def completed(df: DataFrame) -> DataFrame:
    """df with every input column: a registry_reviews_complaints struct or JSON text is opened, others are typed or null."""
    if "registry_reviews_complaints" in df.columns:
        rc = F.col("registry_reviews_complaints")
        rc = rc if isinstance(df.schema["registry_reviews_complaints"].dataType, T.StructType) else F.from_json(rc, COMPLAINTS)
        df = df.withColumns({"reviews_total": rc["reviews_total"], "review_average": rc["average_rating"], "complaints_total": rc["complaints_total"]})
    return df.withColumns({k: F.col(k).try_cast(t) if k in df.columns else F.lit(None).cast(t) for k, t in INPUTS.items()})


def _yes(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _tidy(c: Column, places: int) -> Column:
    """Rounded without the noise of binary sums: 59.949999999999996 is 59.95."""
    return F.round(F.round(c, 8), places)


def _flag(c: Column) -> Column:
    return _yes(c).cast("int")


def _c(name: str) -> Column:
    return text.number(F.col(name)) if INPUTS[name] == "double" else F.col(name)


def has_mapquest_yelp() -> Column:
    return _yes(F.upper(F.trim("mapquest_rating_provider")) == "YELP")


def yelp_rating() -> Column:
    official = F.when(_c("yelp_review_count") >= MIN_REVIEWS, _c("yelp_rating"))
    return F.coalesce(official, F.when(has_mapquest_yelp() & (_c("mapquest_review_count") >= MIN_REVIEWS), _c("mapquest_rating_value")))


def yelp_volume() -> Column:
    return F.coalesce(F.when(F.col("match_status") == "matched", _c("yelp_review_count")), F.when(has_mapquest_yelp(), _c("mapquest_review_count")))


def angi_rating() -> Column:
    return F.when(_c("angi_review_count") >= MIN_REVIEWS, _c("angi_overall_rating"))


def grade() -> Column:
    return grades.points(F.col("registry_rating"))


def review_average() -> Column:
    return F.when(F.col("reviews_total") >= 3, F.round(F.col("review_average"), 2))


def phone() -> Column:
    return F.when(F.coalesce(F.col("registry_phone"), F.lit("")) != "", F.col("registry_phone")).otherwise(F.col("angi_phone"))


def divergence() -> Column:
    """A good grade, and somebody who disagrees."""
    negative = F.col("review_sentiment_negative_count") / F.nullif(F.col("review_sentiment_analyzed_count"), F.lit(0.0))
    doubts = [yelp_rating() < 3, angi_rating() < 3, review_average() < 2.5, F.col("complaints_total") >= 5, negative > 0.5]
    return _flag((grade() >= 3.67) & reduce(Column.__or__, map(_yes, doubts)))


def accredited_low() -> Column:
    low = [yelp_rating() < 3, angi_rating() < 3, review_average() < 3]
    return _flag(text.truthy(F.col("registry_accredited")) & reduce(Column.__or__, map(_yes, low)))


def review_gap(as_of: Column) -> Column:
    gap = _c("avg_review_gap_days")
    return _flag((gap > 0) & (dates.days_since(F.col("most_recent_review_date"), as_of) > 3 * gap))


def sentiment_signal(as_of: Column) -> Column:
    n, bad = F.col("review_sentiment_analyzed_count"), F.coalesce("review_sentiment_negative_count", F.lit(0.0))
    share = bad / F.nullif(n, F.lit(0.0))
    base = F.when(bad == 0, 18.0).when(share <= 0.6, 78.0).when(share < 1, 60.0).otherwise(45.0)
    age = dates.days_since(F.col("most_recent_review_date"), as_of)
    weight = reduce(lambda w, r: w.when(age <= r[0], r[1]), RECENCY[1:], F.when(age <= RECENCY[0][0], RECENCY[0][1])).when(age.isNull(), 0.85).otherwise(0.7)
    return F.when(n > 0, _tidy(F.least(F.lit(100.0), base * weight), 1))


def review_need() -> Column:
    """Only for matched rows and their own counts: few or bad reviews need work."""
    n, y = _c("yelp_review_count"), yelp_rating()
    full = _tidy(100 * (0.6 * (5 - y) / 5 + 0.4 * (1 - F.least(n, F.lit(float(FULL_VOLUME))) / FULL_VOLUME)), 1)
    return F.when((F.col("match_status") == "matched") & n.isNotNull(), F.when((n < MIN_REVIEWS) | y.isNull(), 70.0).otherwise(full))


def _mean(parts: list[Column]) -> Column:
    """The mean of those that are not null; null without any."""
    have = reduce(Column.__add__, [p.isNotNull().cast("int") for p in parts])
    return F.when(have > 0, reduce(Column.__add__, [F.coalesce(p, F.lit(0.0)) for p in parts]) / have)


def blends(as_of: Column) -> dict[str, Column]:
    ok = F.col("facebook_status") == "ok"
    return {
        "yelp": _mean([grades.rating_band(yelp_rating()), grades.volume_band(yelp_volume())]),
        "angi": _mean([grades.rating_band(angi_rating()), F.when(text.has_value(F.col("angi_phone")), grades.volume_band(_c("angi_review_count")))]),
        "sentiment": sentiment_signal(as_of),
        "registry": _mean([grades.grade_band(grade()), grades.rating_band(review_average()), grades.complaint_band(F.col("complaints_total"))]),
        "facebook": _mean([F.when(ok, grades.rating_band(_c("facebook_recommend_percentage") / 20.0)), F.when(ok, grades.volume_band(_c("facebook_review_count")))]),
    }


def lead_score() -> Column:
    """Over the columns of the registry before it, and __blend_*: weighted blend, bonuses, reachability; at most TOP."""
    part = {k: F.col(f"__blend_{k}") for k in SOURCE_WEIGHTS}
    weight = reduce(Column.__add__, [F.when(part[k].isNotNull(), w).otherwise(0.0) for k, w in SOURCE_WEIGHTS.items()])
    base = reduce(Column.__add__, [F.coalesce(part[k] * w, F.lit(0.0)) for k, w in SOURCE_WEIGHTS.items()]) / F.nullif(weight, F.lit(0.0))
    bonus = reduce(Column.__add__, [F.col(k) * float(v) for k, v in BONUS.items()])
    bonus = bonus + F.when(_c("registry_years_in_business") >= TENURE_YEARS, float(TENURE_BONUS)).otherwise(0.0) + F.when(text.truthy(F.col("registry_accredited")), float(ACCREDITED_BONUS)).otherwise(0.0)
    total = base + bonus
    reached = F.when(F.col("has_phone") == 1, total + F.when(F.col("has_named_contact") == 1, float(CONTACT_BONUS)).otherwise(0.0)).otherwise(total * NO_PHONE)
    return _tidy(F.when(reached > TOP, TOP).otherwise(reached), 1)


def registry(as_of: Column) -> list[dict[str, Column]]:
    """Layers of name -> expression; a layer may use the columns of those before it.  One line more is one column more."""
    matched, status = F.col("match_status") == "matched", F.col("match_status")
    contact = F.when((F.col("has_phone") == 1) & (F.col("has_named_contact") == 1), "phone+contact").when(F.col("has_phone") == 1, "phone").when((F.col("has_named_contact") == 1) | (F.col("has_email") == 1), "contact_only").otherwise("none")
    first = {
        "present_registry": _flag(status.isin("matched", "a_only")),
        "present_yelp": _flag(status.isin("matched", "b_only") | has_mapquest_yelp()),
        "present_both": _flag(matched),
        "on_angi": _flag(text.has_value(F.col("angi_name"))),
        "angi_corporate_account": _flag(text.truthy(F.col("angi_is_corporate_account"))),
        "registry_grade_num": grade(),
        "registry_review_avg": review_average(),
        "registry_reviews_total": F.col("reviews_total"),
        "registry_complaints_total": F.col("complaints_total"),
        "rating_gap": _tidy(grade() / 4.33 * 5 - yelp_rating(), 2),
        "reputation_divergence_flag": divergence(),
        "review_need_score": review_need(),
        "low_review_volume_flag": F.when(matched, (_c("yelp_review_count") < LOW_VOLUME).cast("int")),
        "accredited_but_low_rated": accredited_low(),
        "review_sentiment_signal": sentiment_signal(as_of),
        "review_gap_flag": review_gap(as_of),
        "has_phone": _flag(text.has_value(phone())),
        "has_named_contact": _flag(text.has_value(F.col("registry_principal_contact"))),
        "has_email": _flag(text.has_value(F.col("registry_email"))),
        "website_dead_flag": _flag(text.truthy(F.col("website_dead"))),
    }
    return [first | {f"__blend_{k}": c for k, c in blends(as_of).items()}, {"lead_priority_score": lead_score(), "contact_readiness": contact}, {"contact_readiness_score": F.when(F.col("contact_readiness") == "phone+contact", 100).when(F.col("contact_readiness") == "phone", 75).when(F.col("contact_readiness") == "contact_only", 30).otherwise(0)}]


def with_scores(master: DataFrame, as_of: Column | str) -> DataFrame:
    """master with all derived columns, computed anew: running it again changes nothing."""
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    layers = registry(as_of)
    mine = {k for layer in layers for k in layer}
    df = completed(master.drop(*mine))
    for layer in layers:
        df = df.withColumns(layer)
    return df.drop(*[k for k in mine if k.startswith("__")])
