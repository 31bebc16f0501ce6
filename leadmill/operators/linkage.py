"""Linking two listings: blocked candidates, explained scores, one-to-one assignment.

Both sides have the columns of RECORD.  Everything happens within a list (one industry in one place), so `list_id`
is part of every key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo, text
from ..session import large, spread, stored
from . import graph

RECORD = ("list_id", "idx", "name", "phone", "postal", "city", "state", "lat", "lon")
# Weights of the signals, and the limits of the score.
WEIGHTS = {"phone": 0.40, "name": 0.34, "geo": 0.16, "zip": 0.06, "city": 0.04}
CONFIDENT, REVIEW = 0.80, 0.60
NEAR_MILES, BLOCK_MILES = 2.0, 3.0
#: What zips that differ count where city and state are equal.
SAME_PLACE = 0.4
WEAK_NAME, PHONE_NAME, PHONE_FLOOR = 0.50, 0.55, 0.90
#: Parts of a grid cell's records that meet in tasks of their own.
PARTS = 8
#: Records of one point, about, that meet others as one row.
TOGETHER = 1 << 10
#: Pairs of different names that are scored beforehand and sent to all tasks.
NAME_PAIRS = 1 << 18
#: Limits of confidence down to which `matches` goes in turn, and pairs of records of the two sides up to which it goes at once.
BANDS, FEW = (PHONE_FLOOR, 0.75), 1 << 37


def prepared(df: DataFrame) -> DataFrame:
    """RECORD with the keys that blocking and scoring use; dealt first, as a listing of few bytes would be one task's work."""
    return spread(df.select(*RECORD), "list_id", "idx").select(
        "list_id", "idx", "name", "lat", "lon",
        text.phone_key(F.col("phone")).alias("phone"), text.zip5(F.col("postal")).alias("zip"),
        text.city_key(F.col("city")).alias("city"), F.upper(F.trim("state")).alias("state"), text.name_words(F.col("name")).alias("words"),
    )


def candidates(a: DataFrame, b: DataFrame, miles: float = BLOCK_MILES) -> DataFrame:
    """(list_id, a_idx, b_idx, a, b) with equal phone, equal zip, or at most `miles` apart; a and b are the records as structs.

    A union of equi-joins: a single condition with OR would compare all pairs.  The geographic block joins grid
    cells with their neighbours and then measures.  A join leaves out what those before it find, so each pair comes once
    and brings its records along: nothing is made distinct or joined back.
    """
    return _union(_records(met(a, b, "phone"), a, b), *(_records(f, a, b) for f in elsewhere(a, b, miles)))


def _union(*found: DataFrame) -> DataFrame:
    return reduce(DataFrame.union, found)


def _records(found: DataFrame, a: DataFrame, b: DataFrame, *more: Column) -> DataFrame:
    record = lambda side, df: F.struct(*[F.col(f"{side}.`{c}`") for c in df.columns]).alias(side)
    return found.select("a.list_id", F.col("a.idx").alias("a_idx"), F.col("b.idx").alias("b_idx"), record("a", a), record("b", b), *more)


def _same(key: str) -> Column:
    return F.coalesce(F.col(f"a.{key}") == F.col(f"b.{key}"), F.lit(False))


def met(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """Records of a list (aliases a and b) that are equal in all of keys."""
    keys = ("list_id", *keys)
    left = spread(a.where(" and ".join(f"{k} is not null" for k in keys)), *keys)
    return left.alias("a").join(large(b).alias("b"), reduce(Column.__and__, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]))


def elsewhere(a: DataFrame, b: DataFrame, miles: float, *keys: str) -> list[DataFrame]:
    """Records without a common phone: of equal zip, and of other zips at most `miles` apart; keys must be equal as well."""
    return [met(a, b, "zip", *keys).where(~_same("phone")), _near(a, b, miles, *keys).where(~_same("phone") & ~_same("zip"))]


def near(a: DataFrame, b: DataFrame, miles: float) -> DataFrame:
    """(list_id, a_idx, b_idx) of records at most `miles` apart, each pair once."""
    return _met_near(a, b, miles, "idx").select("list_id", F.col("a.idx").alias("a_idx"), F.col("b.idx").alias("b_idx"))


def pairs(a: DataFrame, b: DataFrame, miles: float, *carried: str) -> DataFrame:
    """What `candidates` gives, as (list_id, a, b) with the columns `carried` alone: points are measured, not the records that stand on them."""
    row = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in carried]).alias(side)
    close = _met_near(a, b, miles, *dict.fromkeys([*carried, "phone", "zip"])).where(~_same("phone") & ~_same("zip"))
    return _union(*(f.select("a.list_id", row("a"), row("b")) for f in (met(a, b, "phone"), met(a, b, "zip").where(~_same("phone")))), close.select("list_id", row("a"), row("b")))


def _met_near(a: DataFrame, b: DataFrame, miles: float, *carried: str) -> DataFrame:
    """(list_id, a, b) of records at most `miles` apart, as structs of `carried`: pairs of points meet, and their records go with them in arrays."""
    found = _near(_points(a, *carried), _points(b, *carried), miles)
    found = found.select("a.list_id", F.explode("a.__rows").alias("a"), F.col("b.__rows").alias("__b"))
    return found.select("list_id", "a", F.explode("__b").alias("b"))


def _points(df: DataFrame, *carried: str) -> DataFrame:
    """(list_id, lat, lon, idx, __rows): the records of a point; those of a crowded one are dealt by idx to rows of about TOGETHER."""
    point = ["list_id", "lat", "lon"]
    df = df.where("list_id is not null and lat is not null and lon is not null").select(*point, "idx", F.struct(*carried).alias("__row"))
    crowded = df.groupBy(*point).agg(F.count("*").alias("__k")).where(F.col("__k") > TOGETHER)
    dealt = df.join(crowded, point, "left").withColumn("__chunk", F.pmod(F.xxhash64("idx"), F.coalesce(F.ceil(F.col("__k") / TOGETHER), F.lit(1))))
    return dealt.groupBy(*point, "__chunk").agg(F.min("idx").alias("idx"), F.collect_list("__row").alias("__rows")).drop("__chunk")


def _there(df: DataFrame, side: str) -> DataFrame:
    """Records with a place, and their points on the unit sphere."""
    return df.where("lat is not null and lon is not null").withColumns(dict(zip((f"__{side}x", f"__{side}y", f"__{side}z"), geo.unit(F.col("lat"), F.col("lon")), strict=True)))


def _close(miles: float) -> Column:
    """Whether a and b of `_there` are at most `miles` apart: measured only where the chord is within rounding of the limit."""
    chord = sum(((F.col(f"__a{k}") - F.col(f"__b{k}")) * (F.col(f"__a{k}") - F.col(f"__b{k}")) for k in "yz"), (F.col("__ax") - F.col("__bx")) * (F.col("__ax") - F.col("__bx")))
    low, high = geo.chords(miles)
    return (chord <= high) & ((chord < low) | (geo.distance_miles(F.col("a.lat"), F.col("a.lon"), F.col("b.lat"), F.col("b.lon")) <= miles))


def _cells(a: DataFrame, b: DataFrame, miles: float) -> tuple[DataFrame, DataFrame]:
    """a with its grid cell (cy, cx), and b with a row for every cell around."""
    lat, lon = F.col("lat"), F.col("lon")
    cell = lambda df: df.select("*", "__cell.cy", "__cell.cx").drop("__cell")
    return cell(_there(a, "a").withColumn("__cell", geo.cell(lat, lon, miles))), cell(_there(b, "b").withColumn("__cell", F.explode(geo.cells_around(lat, lon, miles))))


def _near(a: DataFrame, b: DataFrame, miles: float, *keys: str) -> DataFrame:
    placed, around = _cells(a, b, miles)
    placed, around = placed.withColumn("__part", F.pmod(F.xxhash64("idx"), F.lit(PARTS)).cast("int")), around.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    on = ("list_id", "cy", "cx", "__part", *keys)
    met_ = spread(placed, *on).alias("a").join(large(around).alias("b"), reduce(Column.__and__, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in on]))
    return met_.where(_close(miles))


def beside(a: DataFrame, b: DataFrame, miles: float) -> DataFrame:
    """The records of a with one of b in their list at most `miles` apart."""
    placed, around = _cells(a, b, miles)
    on = reduce(Column.__and__, [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("list_id", "cy", "cx")])
    return spread(placed, "list_id", "idx").alias("a").join(large(around).alias("b"), on & _close(miles), "left_semi").select(*a.columns)


def names(a: DataFrame, b: DataFrame, similarity=text.name_similarity, most: int | None = None) -> DataFrame | None:
    """(name_a, name_b, sig_name): every pair of different names (words with blanks between) of the two sides with its score, each compared
    once; None where there are more than `most` (NAME_PAIRS) pairs, or the hashes of two pairs (`pair_key`) are equal."""
    own = lambda df: stored(df.select("words").distinct(), "names")[0]
    x, y = own(a), own(b)
    n = x.count() * y.count()
    if n > (NAME_PAIRS if most is None else most):
        return None
    pairs = x.withColumnRenamed("words", "wa").repartition(1 + n // 4096).crossJoin(F.broadcast(y.withColumnRenamed("words", "wb")))
    pairs = pairs.select(F.array_join("wa", " ").alias("name_a"), F.array_join("wb", " ").alias("name_b"), similarity(F.col("wa"), F.col("wb"), least=0.0).alias("sig_name"))
    pairs = stored(pairs, "scores")[0]
    different = pairs.agg(F.count_distinct(pair_key(F.xxhash64("name_a"), F.xxhash64("name_b")))).first()[0]
    return pairs if n == different else None


def pair_key(a: Column, b: Column) -> Column:
    """Of the XXH64 of two names."""
    return F.xxhash64(a, b)


def similarities(a: DataFrame, b: DataFrame, similarity=text.name_similarity, miles: float = BLOCK_MILES) -> DataFrame:
    """(list_id, a_idx, b_idx, sig_name) of all `candidates`: names that stand on many records are compared once."""
    a, b = stored(a, "a")[0], stored(b, "b")[0]
    scores = names(a, b, similarity)
    if scores is None:
        return signals(candidates(a, b, miles), a, b, similarity).select("list_id", "a_idx", "b_idx", "sig_name")
    hashed = lambda df: df.withColumn("__name", F.xxhash64(F.array_join("words", " "))).drop("name", "words")
    x, y = hashed(a), hashed(b)
    found = pairs(x, y, miles, "idx", "__name").select("list_id", F.col("a.idx").alias("a_idx"), F.col("b.idx").alias("b_idx"), pair_key(F.col("a.__name"), F.col("b.__name")).alias("__pair"))
    known = scores.select(pair_key(F.xxhash64("name_a"), F.xxhash64("name_b")).alias("__pair"), "sig_name")
    return found.join(F.broadcast(known), "__pair").select("list_id", "a_idx", "b_idx", "sig_name")


def named(a: DataFrame, b: DataFrame, scores: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """a with a row for every name (name_b, sig_name) of b that scores at least `least`, and b with its name as name_b.

    What has to be alike in name and near is then met by an equi-join on both, not by all pairs of a place.
    """
    close = F.broadcast(scores.where(F.col("sig_name") >= least))
    own = F.array_join("words", " ")
    return a.withColumn("name_a", own).join(close, "name_a").drop("name_a"), b.withColumn("name_b", own)


def linked(a: DataFrame, b: DataFrame, least: float = REVIEW, similarity=text.name_similarity, miles: float = BLOCK_MILES) -> DataFrame:
    """What `scored` gives of all `candidates`.  Without a common phone a pair needs a name score of WEAK_NAME, and more where both have a
    phone (`least_name`), so those blocks are joined on the names that reach it as well; names that stand on many records are compared once."""
    a, b = stored(a, "a")[0], stored(b, "b")[0]
    return _linked(a, b, names(a, b, similarity), least, similarity, miles)


def _linked(a: DataFrame, b: DataFrame, scores: DataFrame | None, least: float, similarity, miles: float) -> DataFrame:
    if scores is None:
        return scored(candidates(a, b, miles), a, b, least, similarity)
    x, y = (df.select("list_id", "idx", "lat", "lon", "phone", "zip", "city", "state", F.array_join("words", " ").alias("__name")) for df in (a, b))
    by_phone = (F.col("a.__name") == F.col("name_a")) & (F.col("b.__name") == F.col("name_b"))
    found = [_records(met(x, y, "phone").join(F.broadcast(scores.where(F.col("sig_name") >= least_of_phone(least))), by_phone), x, y, F.col("sig_name"))]
    for block, zip_ in ((lambda u, v: met(u, v, "zip", "__kind", "__key"), True), (lambda u, v: _near(u, v, miles, "__kind", "__key").where(~_same("zip")), False)):
        least_names = [max(WEAK_NAME, least_name(least, phone, zip_)) for phone in (False, True)]
        found.append(_records(block(*_apart(x, y, scores, *least_names)).where(~_same("phone")), x, y, F.coalesce("a.__score", "b.__score").alias("sig_name")))
    return _judged(signals(_union(*found), x, y, lambda x, y, least: F.col("p.sig_name")), least)


def matches(a: DataFrame, b: DataFrame, least: float = REVIEW, similarity=text.name_similarity, miles: float = BLOCK_MILES, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """(list_id, a_idx, b_idx, confidence): what `assigned` takes of all that `linked` gives.

    The pass over edges by confidence is cut at the limits of `bands`: the edges of each are made only between records that those
    above have left, so most of the pairs that a sure match settles are never made.  Sides of up to FEW pairs go at once.
    """
    a, b = stored(a, "a")[0], stored(b, "b")[0]
    scores, found = names(a, b, similarity), []
    several = scores is not None and a.count() * b.count() > FEW
    limits = [*[x for x in bands if several and x > least], least]
    for limit in limits:
        taken = assigned(_linked(a, b, scores, limit, similarity, miles).select("list_id", "a_idx", "b_idx", "confidence"))
        found.append(taken)
        if limit > least:
            a, b = (stored(df.join(taken, df["list_id"].eqNullSafe(taken["list_id"]) & df["idx"].eqNullSafe(taken[k]), "left_anti"), "open")[0] for df, k in ((a, "a_idx"), (b, "b_idx")))
    return _union(*found)


def least_of_phone(least: float) -> float:
    """The name score below which no pair of a common phone has a confidence of `least`: all other signals are full, or the floor of similar names holds."""
    rest = 1 - WEIGHTS["name"]
    mean = (least - 0.0001 - rest) / WEIGHTS["name"]
    return min(mean, PHONE_NAME) if least <= PHONE_FLOOR else mean


def least_name(least: float, phone: bool, zip_: bool) -> float:
    """The name score below which no pair without a common phone has a confidence of `least`: phone says whether both have one, zip_ whether
    their zips are equal.  Signals that are there and full only raise the mean; zips that differ count SAME_PLACE at most, or are absent."""
    w = WEIGHTS
    rest, weight = w["geo"] + w["city"], w["name"] + w["geo"] + w["city"] + (w["phone"] if phone else 0)
    zips = [(w["zip"], w["zip"])] if zip_ else [(0, 0), (w["zip"] * SAME_PLACE, w["zip"])]
    # Confidence is rounded to 4 decimals: what is within the last one may reach the limit.
    return min(((least - 0.0001) * (weight + there) - rest - got) / w["name"] for got, there in zips)


def _apart(a: DataFrame, b: DataFrame, scores: DataFrame, open_: float, other: float) -> tuple[DataFrame, DataFrame]:
    """a and b with rows for every name that they may be met under without a common phone: (__kind, __key, __score).

    Kind 0: a has no phone, and b's names that score open_ or more; 1: only b has none, and a's names likewise; 2: both have
    one, and b's names that score `other` or more.  The names are listed on the side that has fewer records, those without a phone.
    """
    own = lambda df, kind: df.withColumns({"__kind": F.lit(kind), "__key": F.col("__name"), "__score": F.lit(None).cast("double")})
    has, none = "phone is not null", "phone is null"

    def each(df, kind, mine, theirs, least):
        close = scores.where(F.col("sig_name") >= least).select(F.col(mine).alias("__name"), F.lit(kind).alias("__kind"), F.col(theirs).alias("__key"), F.col("sig_name").alias("__score"))
        return df.join(F.broadcast(close), "__name").select(*df.columns, "__kind", "__key", "__score")

    left, right = [each(a.where(none), 0, "name_a", "name_b", open_), own(a.where(has), 1)], [own(b, 0), each(b.where(none), 1, "name_b", "name_a", open_)]
    if other <= 1:
        left.append(each(a.where(has), 2, "name_a", "name_b", other))
        right.append(own(b.where(has), 2))
    return _union(*left), _union(*right)


def signals(pairs: DataFrame, a: DataFrame, b: DataFrame, similarity=text.name_similarity, worth: bool = False) -> DataFrame:
    """pairs with sig_phone, sig_name, sig_geo, sig_zip, sig_city: null where a side lacks what the signal needs.

    Pairs of `candidates` have their records with them; bare (list_id, a_idx, b_idx) are joined to a and b.

    worth: leave out pairs that no name score can save, before names are compared: other phones, and no distinctive
    word in common though both have some.
    """
    on = lambda side, k: (F.col("p.list_id") == F.col(f"{side}.list_id")) & (F.col(f"p.{side}_idx") == F.col(f"{side}.idx"))  # noqa: E731, ARG005
    j = pairs.alias("p")
    if not {"a", "b"} <= set(pairs.columns):
        j = j.join(large(a).alias("a"), on("a", 0)).join(large(b).alias("b"), on("b", 0))
    one = lambda c: c.cast("double")
    c = F.col
    if worth:
        j = j.where(F.coalesce(c("a.phone") == c("b.phone"), F.lit(False)) | (text.gate(c("a.words"), c("b.words")) >= WEAK_NAME))
    # Without a common phone a pair needs WEAK_NAME to be worth anything; with one, every score counts.
    asked = F.when(F.coalesce(c("a.phone") == c("b.phone"), F.lit(False)), 0.0).otherwise(WEAK_NAME) if worth else 0.0
    miles = geo.distance_miles(c("a.lat"), c("a.lon"), c("b.lat"), c("b.lon"))
    same_place = (c("a.city") == c("b.city")) & (c("a.city") != "") & (c("a.state") == c("b.state"))
    # Rows of a generator: a filter on the signals is not pushed below them, so each is computed once.
    return j.select("p.list_id", "p.a_idx", "p.b_idx", F.inline(F.array(F.struct(
        F.when(c("a.phone").isNotNull() & c("b.phone").isNotNull(), one(c("a.phone") == c("b.phone"))).alias("sig_phone"),
        similarity(c("a.words"), c("b.words"), least=asked).alias("sig_name"),
        F.greatest(F.when(miles.isNotNull(), F.lit(0.0)), 1 - miles / NEAR_MILES).alias("sig_geo"),
        F.when(c("a.zip").isNotNull() & c("b.zip").isNotNull(), F.when(c("a.zip") == c("b.zip"), 1.0).when(same_place, SAME_PLACE).otherwise(0.0)).alias("sig_zip"),
        F.when((c("a.city") != "") & (c("b.city") != ""), one(c("a.city") == c("b.city"))).alias("sig_city"),
    ))))


def confidence() -> Column:
    """The weighted mean of the signals that are there; a phone match with a similar name has a floor.  4 decimals."""
    have = lambda k: F.col(f"sig_{k}").isNotNull()
    total = reduce(Column.__add__, [F.when(have(k), F.col(f"sig_{k}") * w).otherwise(0.0) for k, w in WEIGHTS.items()])
    weight = reduce(Column.__add__, [F.when(have(k), w).otherwise(0.0) for k, w in WEIGHTS.items()])
    mean = total / weight
    sure = F.coalesce((F.col("sig_phone") == 1) & (F.col("sig_name") >= PHONE_NAME), F.lit(False))
    return F.round(F.when(sure, F.greatest(mean, F.lit(PHONE_FLOOR))).otherwise(mean), 4)


def scored(pairs: DataFrame, a: DataFrame, b: DataFrame, least: float = REVIEW, similarity=text.name_similarity) -> DataFrame:
    """Pairs worth assigning, with signals, confidence and band."""
    return _judged(signals(pairs, a, b, similarity, worth=True), least)


def _judged(s: DataFrame, least: float) -> DataFrame:
    s = s.where((F.coalesce(F.col("sig_phone"), F.lit(0.0)) == 1) | (F.col("sig_name") >= WEAK_NAME)).withColumn("confidence", confidence())
    return s.where(F.col("confidence") >= least).withColumn("band", F.when(F.col("confidence") >= CONFIDENT, "confident").otherwise("review"))


def assigned(edges: DataFrame, left: str = "a_idx", right: str = "b_idx", order: list[tuple[str, str]] | None = None, together: int | None = None) -> DataFrame:
    """One-to-one by best score first, ties by a_idx, b_idx: what a sequential greedy pass over the sorted edges takes."""
    return graph.assigned(edges, "list_id", left, right, order or [("confidence", "descending"), (left, "ascending"), (right, "ascending")], together)


def outcome(a: DataFrame, b: DataFrame, matches: DataFrame) -> DataFrame:
    """(list_id, a_idx, b_idx, match_status, confidence): matched, a_only and b_only rows of both sides."""
    m = matches.select("list_id", "a_idx", "b_idx", F.lit("matched").alias("match_status"), "confidence")
    only_a = a.select("list_id", F.col("idx").alias("a_idx")).join(m, ["list_id", "a_idx"], "left_anti").select("list_id", "a_idx", F.lit(None).cast("long").alias("b_idx"), F.lit("a_only").alias("match_status"), F.lit(None).cast("double").alias("confidence"))
    only_b = b.select("list_id", F.col("idx").alias("b_idx")).join(m, ["list_id", "b_idx"], "left_anti").select("list_id", F.lit(None).cast("long").alias("a_idx"), "b_idx", F.lit("b_only").alias("match_status"), F.lit(None).cast("double").alias("confidence"))
    return m.unionByName(only_a).unionByName(only_b)


def summary(rows: DataFrame) -> DataFrame:
    """Counts of an outcome: a, b, matched, confident, review, a_only, b_only."""
    s, c = F.col("match_status"), F.col("confidence")
    n = lambda cond: F.count_if(cond)
    return rows.agg(n(s != "b_only").alias("a_total"), n(s != "a_only").alias("b_total"), n(s == "matched").alias("matched"), n(F.coalesce(c >= CONFIDENT, F.lit(False))).alias("confident"), n(F.coalesce(c < CONFIDENT, F.lit(False))).alias("review"), n(s == "a_only").alias("a_only"), n(s == "b_only").alias("b_only"))


def prefixed(df: DataFrame, prefix: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keys, *[F.col(c).alias(prefix + c) for c in df.columns if c not in keys])


def master(a: DataFrame, b: DataFrame, rows: DataFrame, a_prefix: str = "registry_", b_prefix: str = "yelp_", include_b_only: bool = True) -> DataFrame:
    """The wide table: matched rows first, then a_only, then b_only by `section`; the absent side is null."""
    rows = rows if include_b_only else rows.where("not (match_status <=> 'b_only')")
    section = F.when(F.col("match_status") == "matched", 0).when(F.col("match_status") == "a_only", 1).otherwise(2)
    wide = rows.withColumn("section", section)
    wide = wide.join(prefixed(a, a_prefix), (F.col("list_id") == F.col(f"{a_prefix}list_id")) & (F.col("a_idx") == F.col(f"{a_prefix}idx")), "left")
    return wide.join(prefixed(b, b_prefix), (F.col("list_id") == F.col(f"{b_prefix}list_id")) & (F.col("b_idx") == F.col(f"{b_prefix}idx")), "left")
