"""State that pages embed: JSON in scripts, assigned objects, streamed chunks, links."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def title(html: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def links(html: Column) -> Column:
    """Distinct href values of anchors, in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1)))


def listing_urls(blob: Column, pattern: str) -> Column:
    """Distinct matches of a profile-URL pattern, first seen first."""
    return F.array_distinct(F.regexp_extract_all(blob, F.lit(pattern), F.lit(0)))


def hub_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(slug, name) of bare `slug.htm` links, each once, by name."""
    found = pages.select(F.explode(F.regexp_extract_all(html, F.lit(r'(?is)<a\s[^>]*?href="([a-z0-9-]+)\.htm"[^>]*>([^<]*)</a>'), F.lit(0))).alias("a"))
    slug = F.regexp_extract("a", r'(?is)href="([a-z0-9-]+)\.htm"', 1)
    name = F.trim(F.regexp_extract("a", r"(?is)>([^<]*)</a>", 1))
    return found.select(slug.alias("slug"), name.alias("name")).where("name <> ''").groupBy("slug").agg(F.min("name").alias("name")).orderBy("name")


class _Scripts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.found: list[tuple[str | None, str | None, str]] = []
        self.open: tuple[str | None, str | None] | None = None
        self.parts: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "script":
            a = dict(attrs)
            self.open, self.parts = (a.get("id"), a.get("type")), []

    def handle_data(self, data):
        if self.open:
            self.parts.append(data)

    def handle_endtag(self, tag):
        if tag == "script" and self.open:
            self.found.append((*self.open, "".join(self.parts)))
            self.open = None


def scripts(html: str) -> list[tuple[str | None, str | None, str]]:
    """(id, type, text) of the scripts of a page."""
    p = _Scripts()
    p.feed(html or "")
    return p.found


def json_texts(html: str) -> Iterator[tuple[str | None, str]]:
    """(id, text) of the scripts that hold JSON."""
    for name, kind, body in scripts(html):
        if "json" in (kind or "") or body.lstrip()[:1] in "{[" and body.strip():
            try:
                json.loads(body)
            except ValueError:
                continue
            yield name, body.strip()


def object_at(source: str, start: int) -> str | None:
    """The JSON object or array that begins at the first bracket from `start`; null if it is broken."""
    at = re.compile(r"[{\[]").search(source, start)
    if not at:
        return None
    try:
        _, end = json.JSONDecoder(strict=False).raw_decode(source, at.start())
    except ValueError:
        return None
    return source[at.start() : end]


def assigned(html: str, name: str) -> str | None:
    """The object of `window.NAME = {...}`."""
    m = re.search(rf"window\.{re.escape(name)}\s*=\s*(?=[{{\[])", html or "")
    return object_at(html, m.end()) if m else None


def flight(html: str) -> str:
    """The text that a page streams in `self.__next_f.push([1, "..."])` pieces."""
    out = []
    for m in re.finditer(r'self\.__next_f\.push\(\[\s*1\s*,\s*("(?:[^"\\]|\\.)*")\s*\]\)', html or "", re.S):
        try:
            out.append(json.loads(m[1], strict=False))
        except ValueError:
            continue
    return "".join(out)


def _series(f):
    return lambda s, *a: pd.Series([None if x is None else f(x, *a) for x in s], dtype="object")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("json", T.StringType())])))
def json_scripts_udf(html: pd.Series) -> pd.Series:
    return _series(lambda x: [{"id": a, "json": b} for a, b in json_texts(x)])(html)


@F.pandas_udf(T.StringType())
def flight_udf(html: pd.Series) -> pd.Series:
    return _series(flight)(html)


def assigned_json(html: Column, name: str) -> Column:
    @F.pandas_udf(T.StringType())
    def found(s: pd.Series) -> pd.Series:
        return _series(lambda x: assigned(x, name))(s)

    return found(html)


def component(blob: Column, anchor: str) -> Column:
    """The JSON object that follows an anchor text in a streamed blob."""

    @F.pandas_udf(T.StringType())
    def found(s: pd.Series) -> pd.Series:
        return _series(lambda x: object_at(x, x.index(anchor) + len(anchor)) if anchor in x else None)(s)

    return found(blob)


def state(pages: DataFrame, html: str, name: str, schema: str) -> DataFrame:
    """pages with `state`: the assigned object `name`, typed.  A page without it has a null state."""
    return pages.withColumn("state", F.from_json(assigned_json(F.col(html), name), schema))


#: Fixed value: the host whose platform has another name than its first label.
PLATFORMS = {"x.com": "twitter"}


def _around(x: str, anchor: str, marker: str, most: int) -> list[str]:
    """The objects around the first places of an anchor text: each begins behind the last marker before its place."""
    out, at = [], x.find(anchor)
    while at >= 0 and len(out) < most:
        start = x.rfind(marker + "{", 0, at)
        found = object_at(x, start + len(marker)) if start >= 0 else None
        if found is None:
            break
        out.append(found)
        at = x.find(anchor, at + len(anchor))
    return out


def all_props(blob: Column, anchor: str, most: int, marker: str = ",null,") -> Column:
    """The objects in which an anchor text lies, of its first `most` places in order."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def found(s: pd.Series) -> pd.Series:
        return _series(lambda x: _around(x, anchor, marker, most))(s)

    return found(blob)


def props(blob: Column, anchor: str, marker: str = ",null,") -> Column:
    """The object in which an anchor text first lies."""
    return F.get(all_props(blob, anchor, 1, marker), 0)


def dot_list(c: Column) -> Column:
    """The parts of a text joined by middle dots, without blanks and without the label "Page"."""
    return F.filter(F.transform(F.split(c, "·"), lambda x: F.trim(x)), lambda x: (x != "") & (F.lower(x) != "page"))


def bare_website(c: Column) -> Column:
    """A URL without query and fragment."""
    return F.regexp_replace(F.trim(c), r"[?#].*$", "")


def platform(url: Column, known: dict[str, str] | None = None) -> Column:
    """The social platform of a URL by its host: a known one, else the host's first label, else "other"."""
    host = F.regexp_replace(F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit(""))), r"^www\.", "")
    named = F.coalesce(*[F.when(host == h, F.lit(p)) for h, p in (known or PLATFORMS).items()])
    return F.when(host == "", F.lit("other")).otherwise(F.coalesce(named, F.substring_index(host, ".", 1)))
