"""Text, phone, name and identifier functions."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legal forms and filler that do not identify a business.
NAME_NOISE = [
    "inc", "incorporated", "llc", "llp", "lllp", "lp", "corp", "corporation",
    "co", "company", "ltd", "limited", "pllc", "pc", "pa", "group", "holdings",
    "enterprises", "the", "of", "and", "at", "a",
]
# Words that unrelated businesses share.
GENERIC_WORDS = [
    "auto", "autos", "motor", "motors", "automotive", "car", "cars", "truck",
    "trucks", "sales", "sale", "service", "services", "repair", "center",
    "centre", "shop", "store", "outlet", "dealer", "dealers", "used", "new",
    "preowned", "wholesale", "broker", "brokers", "import", "imports", "export",
    "exports", "trading", "rental", "rentals", "express", "group", "usa",
    "america", "american", "national", "international", "enterprise",
    "enterprises", "industries", "solutions", "associates", "partners",
]
# Caps of the name score where names have no distinctive word, or share none.
CAP_GENERIC, CAP_DISTINCT = 0.50, 0.45
# Kinds of place that a gazetteer puts behind names.
PLACE_KINDS = ["CDP", "city", "town", "village", "borough", "municipality", "government", "comunidad", "zona urbana", "corporation"]
# How a source disguises e-mail addresses.
EMAIL_DISGUISE = {"!~xK_bL!": "", "__at__": "@", "__dot__": "."}


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def has_value(c: Column) -> Column:
    """Not null and not blank."""
    return F.coalesce(F.trim(c.cast("string")) != "", F.lit(False))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y", "t"), F.lit(False))


def number(c: Column) -> Column:
    """A double, or null for blanks, text and NaN."""
    x = F.expr("null").cast("double") if c is None else c.try_cast("double")
    return F.when(~F.isnan(x), x)


def whole(c: Column) -> Column:
    """An int, decimals cut off towards zero; null where there is no number."""
    return number(c).try_cast("int")


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _national(c: Column) -> Column:
    d = digits(c)
    return F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d)


def phone_key(c: Column) -> Column:
    """Ten digits, a leading country 1 dropped; anything else is no phone."""
    d = _national(c)
    return F.when(F.length(d) == 10, d)


def phone_display(c: Column) -> Column:
    """(XXX) XXX-XXXX for ten digits, other digits as they are, null without any."""
    d = _national(c)
    nice = F.concat(F.lit("("), F.substring(d, 1, 3), F.lit(") "), F.substring(d, 4, 3), F.lit("-"), F.substring(d, 7, 4))
    return F.when(F.length(d) == 10, nice).when(d != "", d)


def squashed(c: Column) -> Column:
    """White space runs become one blank, ends trimmed, empty is null."""
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def zip5(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, "[0-9]{5}", 0), F.lit(""))


def city_key(c: Column) -> Column:
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9 ]", "")), F.lit(""))


def name_words(c: Column, extra: list[str] | None = None) -> Column:
    """Identifying words of a name in order, repeats kept."""
    s = F.replace(F.lower(c), F.lit("&"), F.lit(" and "))
    s = F.replace(F.replace(s, F.lit("'"), F.lit("")), F.lit("’"), F.lit(""))
    words = F.split(F.regexp_replace(s, "[^a-z0-9 ]", " "), " +")
    noise = [*NAME_NOISE, *(extra or []), ""]
    return F.coalesce(F.filter(words, lambda w: ~w.isin(noise)), F.array().cast("array<string>"))


def token_score(a: Column, b: Column) -> Column:
    """Half containment, half Jaccard of two word arrays; 0 where either is empty."""
    sa, sb = F.array_distinct(a), F.array_distinct(b)
    common, union = F.size(F.array_intersect(sa, sb)), F.size(F.array_union(sa, sb))
    least = F.least(F.size(sa), F.size(sb))
    return F.when(least > 0, 0.5 * (common / least) + 0.5 * (common / union)).otherwise(F.lit(0.0))


def gate(a: Column, b: Column) -> Column:
    """The most that a pair of names may score: names without a distinctive word, or without a shared one, are capped."""
    generic = F.lit(GENERIC_WORDS)
    da, db = F.array_except(a, generic), F.array_except(b, generic)
    return F.when((F.size(da) == 0) | (F.size(db) == 0), CAP_GENERIC).when(~F.arrays_overlap(da, db), CAP_DISTINCT).otherwise(F.lit(1.0))


def token_similarity(a: Column, b: Column, least: float | Column = 0.0) -> Column:
    """The part of the name score that needs no sequence matching, gated; 4 decimals."""
    return F.round(F.least(token_score(a, b), gate(a, b)), 4)


@F.pandas_udf(T.DoubleType())
def sequence_ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching characters of two strings by longest common blocks, as a share of their lengths."""
    known: dict[tuple[str, str], float] = {}

    def one(x, y):
        if x is None or y is None:
            return None
        if (x, y) not in known:
            known[x, y] = 1.0 if x == y else SequenceMatcher(None, x, y).ratio()
        return known[x, y]

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def most_ratio(a: Column, b: Column) -> Column:
    """An upper bound of the sequence ratio of two strings, on the JVM.

    Matching blocks keep their order, so they are no longer than the longest common subsequence; and of the characters of both strings
    at least as many lie outside that as their edit distance counts.
    """
    both = F.length(a) + F.length(b)
    return F.when(both > 0, (both - F.levenshtein(a, b)) / both).otherwise(F.lit(1.0))


def compared(a: Column, b: Column, least: float | Column = 0.0) -> Column:
    """Whether the sequence ratio of two word arrays can change their name score: the token score is below the cap, the ratio may
    exceed it, and may reach `least`, below which a score does not matter."""
    tokens = token_score(a, b)
    bound = most_ratio(F.array_join(a, " "), F.array_join(b, " "))
    # Scores are rounded to 4 decimals, so a bound counts as reached by half of the last one.
    return (tokens < gate(a, b)) & (bound > tokens) & (F.least(bound, gate(a, b)) >= least - 0.00005)


def name_similarity(a: Column, b: Column, least: float | Column = 0.0) -> Column:
    """0..1 for two word arrays: the better of token score and sequence ratio, gated; 0 where either is empty.

    least: scores below it may come out lower, as nobody asks for them; the strings of such pairs, and of those whose ratio can't change the
    score, are not compared.
    """
    tokens, most = token_score(a, b), gate(a, b)
    open_ = compared(a, b, least)
    ratio = sequence_ratio_udf(F.when(open_, F.array_join(a, " ")), F.when(open_, F.array_join(b, " ")))
    score = F.round(F.least(F.greatest(F.coalesce(ratio, F.lit(0.0)), tokens), most), 4)
    return F.when(F.coalesce(F.size(a) > 0, F.lit(False)) & F.coalesce(F.size(b) > 0, F.lit(False)), score).otherwise(F.lit(0.0))


def slug(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(s, "^-+|-+$", ""), F.lit("")), F.lit("dataset"))


def text_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def business_id(given: Column, name: Column, address: Column, phone: Column, prefix: str = "src:") -> Column:
    """The source's own id behind `prefix`, else gen: and 20 hex digits over name, address and phone; null if all are blank."""
    plain = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", " "))
    joined = F.concat_ws("|", plain(name), plain(address), plain(phone))
    made = F.when(joined != "||", F.concat(F.lit("gen:"), F.substring(F.sha2(joined, 256), 1, 20)))
    return F.when(F.coalesce(given, F.lit("")) != "", F.concat(F.lit(prefix), given)).otherwise(made)


def without_place_suffix(c: Column) -> Column:
    """A gazetteer name without the kind of place behind it; a name that is nothing else stays."""
    bare = F.trim(F.regexp_replace(c, rf"\s+({'|'.join(PLACE_KINDS)})$", ""))
    return F.when(bare == "", c).otherwise(bare)


def email_plain(c: Column) -> Column:
    """Undo the disguise; nothing left is null."""
    for old, new in EMAIL_DISGUISE.items():
        c = F.replace(c, F.lit(old), F.lit(new))
    return F.nullif(c, F.lit(""))


#: The named references of HTML that almost all pages use; the full list is the standard's, read from Python's html module.
COMMON_REFERENCES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "amp": "&"}
_REFERENCE = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|lt|gt|quot|apos|nbsp|amp);"


@F.pandas_udf(T.StringType())
def unescaped_udf(c: pd.Series) -> pd.Series:
    from html import unescape

    return pd.Series([None if x is None else unescape(x) for x in c], dtype="object")


@F.pandas_udf(T.ArrayType(T.StringType()))
def unescaped_each_udf(c: pd.Series) -> pd.Series:
    from html import unescape

    return pd.Series([None if x is None else [None if y is None else unescape(y) for y in x] for x in c], dtype="object")


def _references(c: Column) -> tuple[Column, Column]:
    """(whether a text needs the full list, the text with its simple references replaced), on the JVM."""
    digits_ = lambda r: F.when(F.lower(r).startswith("#x"), F.conv(F.substr(r, F.lit(3)), 16, 10)).otherwise(F.substr(r, F.lit(2)))
    number_ = lambda r: F.when(F.length(r) <= 9, digits_(r).try_cast("int"))
    # Characters that stand for themselves: not the controls, surrogates and non-characters that the standard maps or drops.
    plain = lambda n: n.isin(9, 10) | n.between(32, 126) | n.between(160, 0xD7FF) | n.between(0xE000, 0xFDCF) | n.between(0xFDF0, 0xFFFD) | (n.between(0x10000, 0x10FFFD) & ((n % 0x10000) < 0xFFFE))
    utf32 = lambda n: F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")
    parts = F.split(c, "&")  # every part but the first follows an ampersand
    named = F.create_map(*[F.lit(x) for pair in COMMON_REFERENCES.items() for x in pair])
    name = lambda p: F.regexp_extract(F.concat(F.lit("&"), p), "^" + _REFERENCE, 1)
    simple = lambda p: (name(p) != "") & F.coalesce(F.when(name(p).startswith("#"), plain(number_(name(p)))).otherwise(F.lit(True)), F.lit(False))
    replaced = lambda p: F.concat(F.when(name(p).startswith("#"), utf32(number_(name(p)))).otherwise(F.try_element_at(named, name(p))), F.substr(p, F.length(name(p)) + 2))
    tail = F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
    # What is neither simple nor surely no reference (an ampersand before two letters or a number sign) needs the list.
    hard = F.contains(c, F.lit("&")) & F.exists(tail, lambda p: ~simple(p) & p.rlike("^(#[0-9xX]|[A-Za-z][A-Za-z0-9])"))
    easy = F.concat(parts[0], F.array_join(F.transform(tail, lambda p: F.when(simple(p), replaced(p)).otherwise(F.concat(F.lit("&"), p))), ""))
    return hard, F.when(F.contains(c, F.lit("&")), easy).otherwise(c)


def entities_plain(c: Column) -> Column:
    """The character references of HTML, named and numeric, replaced as the standard says, each once.

    The common named ones and numbers of plain characters are replaced on the JVM.  Only texts that have another reference (a number that the
    standard maps, a rarer name, a missing semicolon) go to Python, where the full list is.
    """
    hard, easy = _references(c)
    return F.when(hard, unescaped_udf(F.when(hard, c))).otherwise(easy)


def entities_plain_each(c: Column) -> Column:
    """`entities_plain` of every text of an array."""
    hard = F.exists(c, lambda x: F.coalesce(_references(x)[0], F.lit(False)))
    return F.when(hard, unescaped_each_udf(F.when(hard, c))).otherwise(F.transform(c, lambda x: _references(x)[1]))


def sentinel_to_null(c: Column) -> Column:
    t = F.trim(c)
    return F.when(~t.isin("", "$undefined", "-"), t)


def number_text(c: Column) -> Column:
    """Numbers as text without an idle fraction; blanks are null, and what is no number stays as it is."""
    n = c.try_cast("double")
    plain = n.isNotNull() & ~F.isnan(n) & (F.abs(n) < 1e15)
    return F.when(c == "", None).when(plain & (n == F.floor(n)), F.floor(n).cast("string")).when(plain, n.cast("string")).otherwise(c)


def only_strings(c: Column) -> Column:
    """The strings of a JSON array as array<string>; what else it holds is left out; null for anything but an array with strings."""
    items = F.try_variant_get(F.try_parse_json(c), "$", "array<variant>")
    kept = F.transform(F.filter(items, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string"))
    return F.when(F.size(kept) > 0, kept)


def state_city(c: Column) -> Column:
    """struct<state, city> of a place id, cut at its last hyphen; without one all of it is the state."""
    return F.struct(F.substring_index(c, "-", -1).alias("state"), F.regexp_replace(c, "-?[^-]*$", "").alias("city"))


def decoded(c: Column, schema: str) -> Column:
    """JSON text by a schema; null, blank and broken texts are the empty array, or a struct of nulls."""
    empty = "[]" if schema.lower().startswith("array") else "{}"
    return F.coalesce(F.from_json(F.when(F.trim(c) != "", c), schema), F.from_json(F.lit(empty), schema))
