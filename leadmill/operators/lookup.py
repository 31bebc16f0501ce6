"""Cities, radii, categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import geo, text
from .dedupe import first_of


def city(rows: DataFrame, cities: DataFrame, name: str = "city", state: str = "state") -> DataFrame:
    """rows with lat, lon, population of the first city of that name and state, in any case; null where there is none."""
    key = cities.select(F.lower(F.trim("name")).alias("__n"), F.upper(F.trim("state")).alias("__s"), "lat", "lon", "population", "geoid")
    one = first_of(key, [F.col("__n"), F.col("__s")], [F.col("geoid")])
    return rows.join(one, (F.lower(F.trim(name)) == F.col("__n")) & (F.upper(F.trim(state)) == F.col("__s")), "left").drop("__n", "__s")


def within_radius(points: DataFrame, cities: DataFrame, miles: float, least_population: int = 0) -> DataFrame:
    """points (point_id, lat, lon) with the cities around them, miles, and place, nearest first (1 for the nearest; ties by
    geoid): grid cells are joined, then measured."""
    p = points.withColumn("cell", F.explode(geo.cells_around(F.col("lat"), F.col("lon"), miles))).alias("p")
    c = cities.where(F.col("population") >= least_population).withColumn("cell", geo.cell(F.col("lat"), F.col("lon"), miles)).alias("c")
    far = geo.distance_miles(F.col("p.lat"), F.col("p.lon"), F.col("c.lat"), F.col("c.lon"))
    met = p.join(c, (F.col("p.cell.cy") == F.col("c.cell.cy")) & (F.col("p.cell.cx") == F.col("c.cell.cx"))).withColumn("miles", far).where(F.col("miles") <= miles)
    place = F.row_number().over(W.partitionBy("point_id").orderBy("miles", "geoid"))
    return met.select("p.point_id", "c.name", "c.state", "c.geoid", "c.population", "miles").withColumn("place", place)


def sweep(seeds: DataFrame, cities: DataFrame, miles: float = 40.0, least_population: int = 25_000) -> DataFrame:
    """Named places to search: the seeds, and the larger cities around them but the seed itself."""
    found = within_radius(seeds.select(F.col("geoid").alias("point_id"), "lat", "lon"), cities, miles, least_population).where("geoid <> point_id")
    return seeds.select(F.col("geoid").alias("point_id"), "name", "state", "geoid", F.lit(0.0).alias("miles")).unionByName(found.select("point_id", "name", "state", "geoid", "miles"))


#: Characters of the pieces by which texts are looked up that contain others.
GRAM = 3


def _pieces(c: Column, size: Column) -> Column:
    """All stretches of `size` characters, as they come; none of a shorter text."""
    return F.when(F.length(c) >= size, F.transform(F.sequence(F.lit(1), F.length(c) - size + 1), lambda i: F.substr(c, i, size)))


def contained(patterns: DataFrame, texts: DataFrame) -> DataFrame:
    """(p, t): which of the distinct, non-empty patterns (p) the distinct texts (t) contain.

    A text that contains a pattern has all of its pieces of GRAM characters, or the whole of a shorter one.  Each pattern is looked up by the one of its
    pieces that the fewest texts have, so this is an equi-join on rare pieces, whose pairs are then compared.
    """
    none = F.array().cast("array<string>")
    of = texts.select("t", F.explode(F.array_distinct(F.concat(*[F.coalesce(_pieces(F.col("t"), F.lit(k)), none) for k in range(1, GRAM + 1)]))).alias("gram"))
    often = of.groupBy("gram").agg(F.count("*").alias("n"))
    own = patterns.where(F.length("p") > 0).select("p", F.explode(F.array_distinct(_pieces(F.col("p"), F.least(F.length("p"), F.lit(GRAM))))).alias("gram"))
    # A piece that no text has means no match, and counts as the rarest; its pattern then meets nothing.
    rarest = own.join(often, "gram", "left").groupBy("p").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("r")).where("r.n > 0").select("p", "r.gram")
    return rarest.join(of, "gram").where(F.contains("t", "p")).select("p", "t")


def categories(queries: DataFrame, known: DataFrame) -> DataFrame:
    """(query, n, category_id): the exact name, else names that contain the query or are contained in it; an id only if there is one.

    Containment is looked up both ways by rare pieces (`contained`), so neither side is bounded.  Blank queries drop out, blank names name nothing.
    """
    q = queries.select("query", F.lower(F.trim("query")).alias("q")).where("q <> ''")
    k = known.select(F.col("id").alias("category_id"), F.lower(F.trim("name")).alias("k")).where("k <> ''")
    asked, names = q.select("q").distinct(), k.select("k").distinct()
    inside = contained(asked.withColumnRenamed("q", "p"), names.withColumnRenamed("k", "t")).select(F.col("p").alias("q"), F.col("t").alias("k"))
    around = contained(names.withColumnRenamed("k", "p"), asked.withColumnRenamed("q", "t")).select(F.col("t").alias("q"), F.col("p").alias("k")).where("q <> k")
    j = q.join(inside.unionByName(around), "q", "left").join(k, "k", "left")
    g = j.groupBy("query").agg(F.max(F.when(F.col("k") == F.col("q"), F.col("category_id"))).alias("exact"), F.count("category_id").alias("n"), F.min("category_id").alias("some"))
    return g.select("query", F.when(F.col("exact").isNotNull(), F.lit(1).cast("long")).otherwise(F.col("n")).alias("n"), F.coalesce("exact", F.when(F.col("n") == 1, F.col("some"))).alias("category_id"))


def with_population(cities: DataFrame, population: DataFrame) -> DataFrame:
    """Gazetteer places with their population by geoid; names lose the kind of place."""
    return cities.join(population, "geoid").withColumn("name", text.without_place_suffix(F.col("name")))


def parsed_location(c):
    """zip_code, city and state of "12345" or "City, ST"; other texts give nulls."""
    t = F.trim(c)
    pattern = r"^([^,]+),\s*([A-Za-z]{2})$"
    place = t.rlike(pattern)
    return [F.when(t.rlike("^[0-9]{5}$"), t).alias("zip_code"), F.when(place, F.trim(F.regexp_extract(t, pattern, 1))).alias("city"), F.when(place, F.upper(F.regexp_extract(t, pattern, 2))).alias("state")]


def by_slug_token(slugs: DataFrame, known: DataFrame) -> DataFrame:
    """(slug, category_id): the one category whose words all are whole tokens of the slug; none or several give null."""
    s = slugs.select("slug", F.array_distinct(F.split(F.lower("slug"), "[^a-z0-9]+")).alias("t")).withColumn("n", F.lit(1))
    k = known.select(F.col("id").alias("category_id"), F.array_distinct(F.split(F.lower("slug"), "[^a-z0-9]+")).alias("k")).where("size(k) > 0")
    met = s.select("slug", F.explode("t").alias("w")).join(k.select("category_id", F.size("k").alias("need"), F.explode("k").alias("w")), "w")
    full = met.groupBy("slug", "category_id").agg(F.count("*").alias("n"), F.first("need").alias("need")).where("n = need")
    one = full.groupBy("slug").agg(F.count("*").alias("n"), F.min("category_id").alias("category_id")).where("n = 1").select("slug", "category_id")
    return slugs.select("slug").join(one, "slug", "left")
