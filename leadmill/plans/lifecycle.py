"""From raw listings to published lists, all lists in one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import dedupe, enrich, linkage, publish, reviews, scoring
from ..session import kept
from . import steps

#: Columns of the second directory that masters carry.
ANGI = ("name", "phone", "website", "address", "city", "state", "zip_code", "overall_rating", "review_count", "is_corporate_account", "profile_url")


@dataclass(frozen=True)
class Published:
    rows: DataFrame
    counts: DataFrame
    manifest: DataFrame


def linked(registry: DataFrame, other: DataFrame, similarity=text.name_similarity) -> DataFrame:
    """The master of two listings (linkage.RECORD and more): each de-duplicated by phone within its list, then linked one-to-one."""
    a, b = (dedupe.by_phone(df, "phone", [F.col("idx")], ["list_id"]) for df in (registry, other))
    x, y = linkage.prepared(a), linkage.prepared(b)
    return linkage.master(a, b, linkage.outcome(x, y, linkage.assigned(linkage.linked(x, y, similarity=similarity))), include_b_only=False)


def with_angi(master: DataFrame, angi: DataFrame, similarity=text.name_similarity) -> DataFrame:
    """master with angi_ columns by phone, else by place and name; records that nobody claims become rows of their own."""
    rows = master.withColumn("row_idx", F.col("a_idx"))
    asked = rows.select("list_id", "row_idx", F.col("registry_name").alias("name"), F.col("registry_phone").alias("phone"), F.col("registry_city").alias("city"), F.col("registry_postal").alias("postal"))
    found = enrich.phone_first(asked, angi.withColumn("postal", F.col("zip_code")) if "zip_code" in angi.columns else angi, similarity=similarity)
    cells = angi.select("list_id", F.col("idx").alias("other_idx"), *[F.col(c).alias(f"angi_{c}") for c in ANGI if c in angi.columns])
    have = rows.join(found.where("how <> 'new'").select("list_id", "row_idx", "other_idx"), ["list_id", "row_idx"], "left").join(cells, ["list_id", "other_idx"], "left")
    new = found.where("how = 'new'").select("list_id", "other_idx").join(cells, ["list_id", "other_idx"]).withColumn("match_status", F.lit("angi_only")).withColumn("section", F.lit(3))
    return have.unionByName(new, allowMissingColumns=True).drop("other_idx", "row_idx")


def with_reviews(master: DataFrame, analysed: DataFrame) -> DataFrame:
    """master with the review columns of its registry row; analysed: list_id, a_idx and the columns of reviews.rollup."""
    key = analysed.withColumn("k", F.struct("list_id", "a_idx"))
    rolled = reviews.rollup(key, "k").select("k.list_id", "k.a_idx", "*").drop("k")
    return master.join(rolled, ["list_id", "a_idx"], "left")


def enriched(master: DataFrame, todo: list[steps.Step], keep=kept) -> tuple[DataFrame, DataFrame]:
    """master (with row_id) after all enrichment steps, and the work list of what is still open; a step's rows are kept before the next one."""
    rows = steps.applied(master, todo, keep)
    return rows, steps.work_list(rows, todo)


def published(master: DataFrame, lists: DataFrame, as_of: str) -> Published:
    """Scores, curation, public rows and manifest; lists: list_id, industry, metro."""
    named = master.drop("industry", "metro").join(lists, "list_id")
    rows, counts = publish.published(scoring.completed(named), as_of, ["industry", "metro"])
    return Published(rows, counts, publish.manifest(rows, as_of))
