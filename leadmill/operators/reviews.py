"""Reviews of several sources: opened, analysed once, rolled up for each business."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, text

REVIEW = "array<struct<text: string, rating: double, date: string, date_label: string>>"
SENTIMENTS = ("positive", "neutral", "mixed", "negative")


def opened(rows: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """(key, source, pos, text, rating, date, text_hash): JSON arrays of reviews by source; bad JSON and empty texts are skipped."""
    parts = []
    for source, column in columns.items():
        parsed = F.from_json(F.col(column), REVIEW)
        one = rows.select(key, F.lit(source).alias("source"), F.posexplode(parsed).alias("pos", "r"))
        parts.append(one)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    body = F.trim(F.col("r.text"))
    out = out.where(text.has_value(F.col("r.text")))
    return out.select(key, "source", "pos", body.alias("text"), F.col("r.rating").alias("rating"), dates.loose_date(F.coalesce(F.col("r.date"), F.col("r.date_label"))).alias("date"), text.text_hash(body).alias("text_hash"))


def validated(raw: DataFrame) -> DataFrame:
    """Model output made safe: unknown sentiments are neutral, severity is within 1 and 5, the pitch flag is a boolean."""
    s = F.lower(F.trim("sentiment"))
    return raw.withColumns({
        "sentiment": F.when(s.isin(*SENTIMENTS), s).otherwise("neutral"),
        "severity": F.greatest(F.lit(1), F.least(F.lit(5), F.coalesce(text.whole(F.col("severity")), F.lit(1)))),
        "actionable": text.truthy(F.col("actionable")),
    })


def analysed(reviews: DataFrame, cache: DataFrame, analyse: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """(source, text_hash, sentiment, severity, theme, summary, actionable) of every distinct review: from the cache, or by `analyse`.

    `analyse` takes a frame with source, text_hash and text and returns the output columns; rows it leaves out failed
    and stay without an analysis.
    """
    wanted = "source string, text_hash string, sentiment string, severity string, theme string, summary string, actionable string"
    todo = reviews.select("source", "text_hash", "text").dropDuplicates(["source", "text_hash"]).join(cache.select("source", "text_hash"), ["source", "text_hash"], "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield analyse(pdf)

    return validated(todo.mapInPandas(run, wanted)).unionByName(cache.select("source", "text_hash", "sentiment", "severity", "theme", "summary", "actionable"))


def rollup(reviews: DataFrame, key: str) -> DataFrame:
    """For each business: counts, the latest (negative) review and its source, the average gap in days, the top complaint.

    The gaps between sorted dates add up to last minus first, so no window is needed.
    """
    bad = F.col("sentiment") == "negative"
    dated = lambda cond: F.max(F.when(cond & F.col("date").isNotNull(), F.struct("date", "source")))
    n = F.count("date")
    rank = F.struct(F.coalesce("actionable", F.lit(False)).cast("int").alias("a"), F.coalesce("severity", F.lit(0)).alias("s"), F.coalesce("date", F.lit("0001-01-01").cast("date")).alias("d"), (F.col("source") == "mapquest").cast("int").alias("m"), (-F.col("pos")).alias("p"))
    g = reviews.groupBy(key).agg(
        F.count("sentiment").alias("analyzed"), F.count_if(bad).alias("negative"), dated(F.lit(True)).alias("last"), dated(bad).alias("last_bad"),
        F.when(n >= 2, F.round(F.date_diff(F.max("date"), F.min("date")) / (n - 1), 1)).alias("gap"),
        F.max_by(F.struct("theme", "summary"), F.when(bad, rank)).alias("top"),
    )
    return g.select(
        key, F.col("analyzed").alias("review_sentiment_analyzed_count"), F.col("negative").alias("review_sentiment_negative_count"),
        F.col("last.date").alias("most_recent_review_date"), F.col("last.source").alias("most_recent_review_source"),
        F.col("last_bad.date").alias("most_recent_negative_review_date"), F.col("last_bad.source").alias("most_recent_negative_review_source"),
        F.col("gap").alias("avg_review_gap_days"), F.when(F.col("negative") > 0, F.col("top.theme")).alias("top_complaint_theme"), F.when(F.col("negative") > 0, F.col("top.summary")).alias("top_complaint_summary"),
    )


def has_any(*columns: str) -> Column:
    """Some JSON column holds reviews."""
    one = lambda c: F.coalesce(~F.trim(c).isin("", "[]"), F.lit(False))
    return F.greatest(*map(one, columns)) if len(columns) > 1 else one(columns[0])


def first_per_business(reviews: DataFrame, key: str, most: int = 50) -> DataFrame:
    """At most `most` reviews of a business, in their order."""
    from pyspark.sql import Window as W

    rn = F.row_number().over(W.partitionBy(key).orderBy("pos"))
    return reviews.withColumn("__rn", rn).where(F.col("__rn") <= most).drop("__rn")
