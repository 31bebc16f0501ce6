"""Letter grades and the bands of ratings and volumes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letter grades as points.
GRADES = {
    "A+": 4.33, "A": 4.0, "A-": 3.67,
    "B+": 3.33, "B": 3.0, "B-": 2.67,
    "C+": 2.33, "C": 2.0, "C-": 1.67,
    "D+": 1.33, "D": 1.0, "D-": 0.67,
    "F": 0.0,
}


def points(c: Column) -> Column:
    """NR, blanks and unknown grades are null."""
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in GRADES.items()))
    return F.try_element_at(table, F.coalesce(F.replace(F.upper(F.trim(c)), F.lit(" "), F.lit("")), F.lit("")))


def rating_band(r: Column) -> Column:
    """Highest in the fixable middle of a 0-5 rating."""
    return F.when(r <= 1.5, 45.0).when(r < 3.7, 82.0).when(r < 4.2, 34.0).when(r.isNotNull(), 8.0)


def volume_band(n: Column) -> Column:
    return F.when(n == 0, 40.0).when(n <= 60, 72.0).when(n <= 150, 40.0).when(n.isNotNull(), 12.0)


def grade_band(g: Column) -> Column:
    return F.when(g.between(1.67, 3.33), 65.0).when(g < 1.67, 32.0).when(g.isNotNull(), 22.0)


def complaint_band(n: Column) -> Column:
    return F.when(n == 0, 30.0).when(n <= 10, 68.0).when(n <= 25, 50.0).when(n.isNotNull(), 25.0)
