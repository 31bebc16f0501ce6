"""De-duplication by an explicit order: the first row of a key stays.  Never by partition order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text


def first_of(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row for each combination of keys (nulls are a key): the first in `order`.  Plans as a partial and a final group limit."""
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rn", rn).where("__rn = 1").drop("__rn")


def by_id(df: DataFrame, key: str, order: str = "row_idx") -> DataFrame:
    return first_of(df, [F.col(key)], [F.col(order)])


def by_phone(df: DataFrame, phone: str, order: list[Column], within: list[str] | None = None) -> DataFrame:
    """First row of each usable phone number; rows without one never merge.

    Only rows with a phone are grouped, so a table of blanks is not one hot group.
    """
    keyed = df.withColumn("__phone", text.phone_key(F.col(phone)))
    named = first_of(keyed.where("__phone is not null"), [*(F.col(c) for c in within or []), F.col("__phone")], order)
    return named.unionByName(keyed.where("__phone is null")).drop("__phone")


def newest_by_phone(df: DataFrame, phone: str, stamp: str, tie: str = "row_idx") -> DataFrame:
    return by_phone(df, phone, [F.col(stamp).desc_nulls_last(), F.col(tie)])


def details_first(details: DataFrame, summaries: DataFrame, key: str, order: str = "row_idx") -> DataFrame:
    """Both tables, one row a key: a detail row beats a summary row."""
    both = details.withColumn("__rank", F.lit(0)).unionByName(summaries.withColumn("__rank", F.lit(1)), allowMissingColumns=True)
    return first_of(both, [F.col(key)], [F.col("__rank"), F.col(order)]).drop("__rank")


def schema_union(frames: list[DataFrame]) -> DataFrame:
    """All rows, with the sorted union of the columns; what a table lacks is null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.select(*sorted(out.columns))


def without(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of work that are not done yet."""
    return work.select(*keys).distinct().join(done.select(*keys).distinct(), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new, and of old what new does not replace."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)
