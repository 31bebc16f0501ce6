"""Dates from the texts that review sources write."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loose_date(c: Column) -> Column:
    """ISO day (longer texts by their first ten characters), or `Month YYYY` and `Mon YYYY` as the first of the month; else null."""
    t = F.trim(c)
    iso = F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"))
    month = F.when(t.rlike(r"^[A-Za-z]+ [0-9]{4}$"), F.coalesce(F.try_to_date(t, "MMMM yyyy"), F.try_to_date(t, "MMM yyyy")))
    return F.coalesce(iso, month)


def date_text(year: Column, month: Column, day: Column) -> Column:
    """ISO text of separate numbers, not validated; null if any is missing."""
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), F.format_string("%04d-%02d-%02d", year, month, day))


def days_since(c: Column, as_of: Column) -> Column:
    return F.date_diff(as_of, c)


def day_only(c: Column) -> Column:
    return F.nullif(F.substring(c, 1, 10), F.lit(""))
