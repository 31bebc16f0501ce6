"""Distances and points on a sphere, in miles and degrees."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_MILES = 3958.8


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if any coordinate is."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_MILES * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))  # least() would take 1 for a null


def unit(lat: Column, lon: Column) -> tuple[Column, Column, Column]:
    """The point on the unit sphere."""
    p, t = F.radians(lat), F.radians(lon)
    return F.cos(p) * F.cos(t), F.cos(p) * F.sin(t), F.sin(p)


def chords(miles: float) -> tuple[float, float]:
    """Squared chords of the unit sphere: points below the first are surely at most `miles` apart, beyond the second surely more; rounding stays below
    1e-12 in either."""
    chord = 2 * math.sin(min(miles / EARTH_MILES / 2, math.pi / 2))
    return max(chord - 1e-12, 0.0) ** 2, (chord + 1e-12) ** 2


def destination(lat: Column, lon: Column, bearing: Column, miles: Column) -> tuple[Column, Column]:
    """Where a bearing (degrees) and distance lead; longitude within -180 and 180."""
    p, way, b = F.radians(lat), miles / EARTH_MILES, F.radians(bearing)
    to = F.asin(F.sin(p) * F.cos(way) + F.cos(p) * F.sin(way) * F.cos(b))
    turn = F.atan2(F.sin(b) * F.sin(way) * F.cos(p), F.cos(way) - F.sin(p) * F.sin(to))
    return F.degrees(to), F.pmod(lon + F.degrees(turn) + 540, F.lit(360.0)) - 180


def coverage_points(places: DataFrame, radius: float, points: int, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Each place as point 0, then an inner ring at half the radius and an outer one: the other points in two halves."""
    inner = max(0, (points - 1) // 2)
    k = F.col("point")
    ring = F.when(k == 0, 0).when(k <= inner, 1).otherwise(2)
    within = F.when(k <= inner, k - 1).otherwise(k - 1 - inner)
    size = F.when(k <= inner, F.lit(inner)).otherwise(F.lit(max(1, points - 1 - inner)))
    rows = places.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(max(0, points - 1))))).withColumn("ring", ring)
    to_lat, to_lon = destination(F.col(lat), F.col(lon), 360.0 * within / F.greatest(size, F.lit(1)), F.col("ring") * (radius / 2))
    centre = k == 0
    return rows.withColumn("point_lat", F.when(centre, F.col(lat)).otherwise(to_lat)).withColumn("point_lon", F.when(centre, F.col(lon)).otherwise(to_lon))


def _band(lat: Column, miles: float) -> Column:
    return F.floor(lat / (miles / 69.0)).cast("long")


def _width(band: Column, miles: float) -> Column:
    """Degrees of longitude that no two points within `miles` exceed, one of them in the band and the other at most one band away."""
    height = miles / 69.0
    edge = F.least(F.greatest(F.abs((band - 1) * height), F.abs((band + 2) * height)), F.lit(90.0))
    ratio = math.sin(min(miles / EARTH_MILES / 2, math.pi / 2)) / F.greatest(F.cos(F.radians(edge)), F.lit(1e-12))
    return F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0)))) + 1e-9


def cell(lat: Column, lon: Column, miles: float) -> Column:
    """The grid cell (cy, cx) of a point.  Bands of latitude have cells of their own width, so the grid holds up to the poles."""
    band = _band(lat, miles)
    return F.struct(band.alias("cy"), F.floor(lon / _width(band, miles)).cast("long").alias("cx"))


def cells_around(lat: Column, lon: Column, miles: float) -> Column:
    """The cells in which all points within `miles` of a point lie, across the date line as well."""

    def of_band(dy):
        band = _band(lat, miles) + dy
        width = _width(band, miles)
        turns = F.filter(F.array(lon, lon - 360, lon + 360), lambda x: (x >= -180 - width) & (x <= 180 + width))
        return F.flatten(F.transform(turns, lambda x: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda dx: F.struct(band.alias("cy"), (F.floor(x / width) + dx).cast("long").alias("cx")))))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(-1).cast("long"), F.lit(1).cast("long")), of_band)))
