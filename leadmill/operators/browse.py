"""Reading a published list: search, sort, top rows, options and exports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text, urls
from ..session import kept


def search(rows: DataFrame, needle: str, fields: list[str]) -> DataFrame:
    """Rows whose fields, joined by blanks, contain the needle in any case; an empty needle finds all."""
    hay = F.lower(F.concat_ws(" ", *[F.col(f).cast("string") for f in fields]))
    return rows.where(F.contains(hay, F.lit(needle.strip().lower()))) if needle.strip() else rows


def typed_order(c: Column, descending: bool = False) -> list[Column]:
    """Numbers by value, then texts by text; what is not a number comes last in both directions, nulls after all."""
    n = text.number(c.cast("string"))
    up = lambda x: x.desc_nulls_last() if descending else x.asc_nulls_last()
    return [n.isNull().asc(), up(n), up(c.cast("string"))]


def ranked(rows: DataFrame, order: list[Column | str]) -> DataFrame:
    """rows with their position (from 0) in one order of all rows: ranges are sorted by themselves, and each starts
    after the rows of the ranges before it.  What one task sees of all ranges is a count each."""
    n = F.monotonically_increasing_id()  # the range, and the place in it
    sorted_ = kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__n", n)).withColumn("__range", F.shiftright("__n", 33))
    ranges = sorted_.groupBy("__range").agg(F.min("__n").alias("__low"), F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("__range", (before - F.col("__low")).alias("__shift"))
    return sorted_.join(F.broadcast(ranges), "__range").withColumn("position", F.col("__n") + F.col("__shift")).drop("__n", "__range", "__shift")


def chosen(rows: DataFrame, **values: str | None) -> DataFrame:
    """Rows with the chosen value in every column; a blank choice takes all."""
    for column, value in values.items():
        rows = rows.where(F.col(column) == value) if value else rows
    return rows


def dataset_order(recent: bool = False) -> list[Column]:
    """By industry and metro, or the newest publication first and those without a date last."""
    by_name = [F.col("industry").asc(), F.col("metro").asc()]
    return [F.nullif("published_at", F.lit("")).desc_nulls_last(), *by_name] if recent else by_name


def sort_keys() -> dict[str, Column]:
    """Keys of the derived columns that a list is sorted by: one rating, flags raised, the newest review, sources."""
    flag = lambda *names: flag_count(*names)
    on = lambda c: (F.coalesce(F.col(c).cast("string"), F.lit("")).isin("true", "1")).cast("int")
    return {
        "rating": F.coalesce("yelp_rating", "angi_rating", "registry_review_avg"), "review_date": F.coalesce("most_recent_negative_review_date", "most_recent_review_date"),
        "flags": flag("reputation_divergence_flag", "accredited_but_low_rated", "website_dead_flag", "review_gap_flag"), "sources": on("on_registry") + on("on_yelp") + on("on_angi"),
    }


def top(rows: DataFrame, score: str, n: int, tie: list[str]) -> DataFrame:
    """The n best; rows without a score come last.  Plans as a top-k of every partition."""
    return rows.orderBy(F.col(score).desc_nulls_last(), *tie).limit(n)


def options(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def landing(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count("*").alias("datasets"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"), F.coalesce(F.sum("yelp_matched"), F.lit(0)).alias("matched"), F.count_distinct("metro").alias("metros"))


def flag_count(*flags: str) -> Column:
    return reduce(Column.__add__, [F.coalesce(F.col(f).cast("int"), F.lit(0)) for f in flags])


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """Counts, most common first."""
    return rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def status_counts(rows: DataFrame, column: str = "status") -> DataFrame:
    """Counts of website statuses, most common first, each beside the number of dead sites."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"))  # a row for each of the statuses there are
    dead = F.coalesce(F.sum(F.when(urls.is_dead(F.col(column)), F.col("n"))).over(W.partitionBy()), F.lit(0))
    return counts.withColumn("dead", dead).orderBy(F.desc("n"), column)


def tally(rows: DataFrame, by: list[str], **conditions: Column) -> DataFrame:
    """Rows, and rows for which each named condition holds, for every list: the progress figures of a run."""
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()])


def observed(rows: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """rows, and counters that are filled while they are written: no pass of their own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in conditions.items()]), seen
