"""What is fit to publish: no chains, no corporate accounts, no weak leads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text

# Fixed values.
CHAIN, LEAST_SCORE = 3, 50.0
REASONS = ("chain_name", "corporate_account", "low_score")


def name_key(first: str = "registry_name", second: str = "angi_name") -> Column:
    c = F.coalesce(F.nullif(F.col(first), F.lit("")), F.col(second), F.lit(""))
    return F.nullif(F.lower(F.trim(c)), F.lit(""))


def chains(rows: DataFrame, name: Column, within: list[str], least: int = CHAIN) -> DataFrame:
    """(within, name_key, n): names that a list has at least `least` times.  Blank names are no chain."""
    return rows.select(*within, name.alias("name_key")).where("name_key is not null").groupBy(*within, "name_key").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def reasons(rows: DataFrame, name: Column, corporate: Column, score: Column, within: list[str], chain: int = CHAIN, least: float = LEAST_SCORE) -> DataFrame:
    """rows with drop_reason: the first of REASONS that holds, or null.  Counts are joined, not windowed: a chain is a small row."""
    found = chains(rows, name, within, chain).withColumn("__chain", F.lit(True)).drop("n")
    j = rows.withColumn("name_key", name).join(found, [*within, "name_key"], "left")
    weak = score.isNull() | (score < least)
    reason = F.when(F.col("__chain"), REASONS[0]).when(text.truthy(corporate), REASONS[1]).when(weak, REASONS[2])
    return j.withColumn("drop_reason", reason).drop("__chain", "name_key")


def counts(marked: DataFrame, within: list[str]) -> DataFrame:
    """Dropped rows by reason, zeros included, and what is kept."""
    return marked.groupBy(*within).agg(*[F.count_if(F.coalesce(F.col("drop_reason") == r, F.lit(False))).alias(r) for r in REASONS], F.count_if(F.col("drop_reason").isNull()).alias("kept"))


def repeat_histogram(rows: DataFrame, name: Column) -> DataFrame:
    """(seen, names): how many names are seen once, twice, three times or more."""
    per = rows.select(name.alias("k")).where("k is not null").groupBy("k").agg(F.count("*").alias("n"))
    return per.groupBy(F.least("n", F.lit(3)).cast("long").alias("seen")).agg(F.count("*").alias("names"))
