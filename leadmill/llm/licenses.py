"""License scans: MinHash bands over overlapping windows find templates, exact shingle containment verifies.

Texts and templates are cut into lower-cased words (letters and digits) and shingles of five words; a template of
fewer words is one shingle of its length.  Templates are sorted into classes by their number of shingles: of class
N those with N/4 to N.  Windows of class N have 2N shingles and start every N, so any copy of such a template lies
whole in a window.  A band is one MinHash value, and a class has as many bands as make the chance of missing a window
that holds CONTAINED of its smallest template less than MISS.  Windows that share a band with a template
are verified around the place: the share of the template's shingles found there must reach CONTAINED.

The templates are the only table that goes to every task; they are bounded by MOST_TEMPLATES words.  Texts are
scanned whole where they lie, several short ones at a time and long ones in overlapping pieces; nothing is shuffled.

Defined results: null and empty texts hold no license; null doc_ids are scanned like others; repeated rows give equal
rows; an empty template never matches; overlapping places of one license are reported as one, and so are those of
licenses that differ in a clause (`settled`); texts of any length are scanned whole; other columns are not read; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from heapq import heappop, heappush
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS, CONTAINED, MISS, SEED = 5, 0.8, 1e-3, 29
#: Shingles of the largest templates of each class: powers of 4.
CLASSES = (1, 4, 16, 64, 256, 1024, 4096, 16384, 65536, 262144, 1048576, 4194304)
MOST_TEMPLATES = 2_000_000
#: Words that are scanned at a time.
PIECE = 1 << 17
#: Characters whose words are held as strings at a time.
TEXT_PIECE = 1 << 20
WORD, BLANK = re.compile(r"[^\W_]+"), re.compile(r"\s")

#: License notices: fixed public wording.  Full texts are in the folder `templates`, a file for each license.
NOTICES = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    "MIT": ("Released under the MIT License.", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    "GPL-2.0": ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",),
    "LGPL-2.1": ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",),
    "LGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "AGPL-3.0": ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
    "all-rights-reserved": ("All rights reserved.",),
}


def library() -> list[tuple[str, str]]:
    """(license, text) of all notices and full texts."""
    texts = [(f.stem, f.read_text("utf-8")) for f in sorted((Path(__file__).parent / "templates").glob("*.txt"))]
    return [(name, x) for name, notices in NOTICES.items() for x in notices] + texts


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def word_hashes(text: str, known: _Hashes) -> np.ndarray:
    out, at = [], 0
    while at < len(text) or not out:  # long texts in pieces that end at white space
        end = len(text) if len(text) - at <= TEXT_PIECE else next((m.end() for m in BLANK.finditer(text, at + TEXT_PIECE)), len(text))
        found = WORD.findall(text[at:end].lower())
        out.append(np.fromiter(map(known.__getitem__, found), np.uint64, len(found)))
        at = end
    return out[0] if len(out) == 1 else np.concatenate(out)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of `size` words; as many as words, the last ones without meaning."""
    out = np.zeros(len(words), np.uint64)
    for k in range(min(size, len(words))):
        out[: len(words) - k] = (out[: len(words) - k] ^ words[k:]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def bands_of(n: int, low: int) -> int:
    """Bands of class n, whose templates have at least `low` shingles."""
    return int(np.ceil(np.log(MISS) / np.log1p(-CONTAINED * low / (2 * n + (1 - CONTAINED) * low))))


def multipliers(count: int) -> np.ndarray:
    return np.random.default_rng(SEED).integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray, k: np.uint64) -> np.ndarray:
    y = x * k
    return y ^ y >> np.uint64(32)


class Templates:
    """The templates by shingle size and class, and the band values that lead to them."""

    def __init__(self, templates: list[tuple[str, str]]):
        known = _Hashes()
        self.names, self.sets, self.sizes, self.spans = [], [], [], []
        self.classes: dict[tuple[int, int], list[int]] = {}
        for name, text in templates:
            words = word_hashes(text or "", known)
            if not len(words):
                continue
            size = min(WORDS, len(words))
            own = np.unique(shingles(words, size)[: len(words) - size + 1])
            n = next((c for c in CLASSES if len(words) - size + 1 <= c), CLASSES[-1])
            self.classes.setdefault((size, n), []).append(len(self.names))
            self.names.append(name)
            self.sets.append(own)
            self.sizes.append(size)
            self.spans.append(len(words) - size + 1)
        self.tables = {}
        for (size, n), of in self.classes.items():
            bands = bands_of(n, min(len(self.sets[t]) for t in of))
            made = []
            for k in multipliers(bands):
                least = np.array([mixed(self.sets[t], k).min() for t in of], np.uint64)
                gate = np.zeros(1 << 16, bool)
                gate[(least >> np.uint64(48)).astype(np.int64)] = True
                made.append((least, gate))
            self.tables[size, n] = made

    def scan(self, words: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
        """(template, first word, words, containment) of verified places, in no order.  A place lies in one owner's words."""
        for size in {size for size, _ in self.tables}:
            x = shingles(words, size)
            own = sorted((n, bands) for (z, n), bands in self.tables.items() if z == size)
            top = own[-1][0]
            padded = np.concatenate([x, np.full(-len(x) % top, x[-1] if len(x) else 0, np.uint64)])
            places: set[tuple[int, int, int]] = set()
            for b, k in enumerate(multipliers(max(len(bands) for _, bands in own))):
                low, held = mixed(padded, k), 1  # one hashing serves all classes: minima of 4 are folded to those of 16, and so on
                for n, bands in own:
                    while held < n:
                        low, held = np.minimum(np.minimum(low[0::4], low[1::4]), np.minimum(low[2::4], low[3::4])), held * 4
                    if b < len(bands):
                        least, gate = bands[b]
                        window = np.minimum(low, np.append(low[1:], low[-1:]))  # two blocks are a window
                        for w in np.flatnonzero(gate[(window >> np.uint64(48)).astype(np.int64)]):
                            places.update((self.classes[size, n][t], n, int(w)) for t in np.flatnonzero(least == window[w]))
            # Windows of one template whose surroundings meet are verified together, so no word is looked at twice for a template.
            spans: list[list[int]] = []
            for t, start, end in sorted((t, w * n - self.spans[t], (w + 2) * n + self.spans[t]) for t, n, w in places):
                if spans and spans[-1][0] == t and start <= spans[-1][2]:
                    spans[-1][2] = max(spans[-1][2], end)
                else:
                    spans.append([t, start, end])
            for t, start, end in spans:
                yield from self.verified(t, x, owner, max(0, start), min(len(x) - size + 1, end))

    def verified(self, t: int, x: np.ndarray, owner: np.ndarray, start: int, end: int) -> Iterator[tuple[int, int, int, float]]:
        own, span, size = self.sets[t], self.spans[t], self.sizes[t]
        at = start + np.flatnonzero(np.isin(x[start : max(start, end)], own))
        at = at[owner[at] == owner[at + size - 1]]
        need = CONTAINED * len(own)
        for mine in np.split(at, np.flatnonzero(np.diff(owner[at])) + 1):
            ids = np.unique(x[mine], return_inverse=True)[1]
            if len(mine) and ids.max() + 1 >= need:
                for first, last, got in stretches(mine.tolist(), ids.tolist(), span, size, need):
                    yield t, first, last + size - first, got / len(own)


def stretches(at: list[int], ids: list[int], span: int, size: int, need: float) -> Iterator[tuple[int, int, int]]:
    """(first, last, distinct ids) of the places of a template among its hits, which are sorted: the stretch of `span` words with the most distinct
    ids (ties: the first), then the best of what lies beside it, and so on, down to `need`.

    One pass of two pointers counts all stretches; a place that is taken changes only those that reach into it, and a heap knows the best.
    """
    alive, counts = [True] * len(at), [0] * len(at)
    heap: list[tuple[int, int]] = []

    def count(low: int, high: int) -> None:
        """The stretches that start at hits low..high - 1."""
        held: dict[int, int] = {}
        end = low
        for i in range(low, high):
            while end < len(at) and at[end] < at[i] + span:
                if alive[end]:
                    held[ids[end]] = held.get(ids[end], 0) + 1
                end += 1
            if alive[i]:
                if len(held) >= need and len(held) != counts[i]:
                    heappush(heap, (-len(held), i))
                counts[i] = len(held)
                held[ids[i]] -= 1
                if not held[ids[i]]:
                    del held[ids[i]]

    count(0, len(at))
    while heap:
        got, i = heappop(heap)
        if not alive[i] or counts[i] != -got:
            continue
        last = next(j for j in range(bisect_left(at, at[i] + span) - 1, -1, -1) if alive[j])
        yield at[i], at[last], -got
        low, high = bisect_right(at, at[i] - size), bisect_left(at, at[last] + size)
        alive[low:high] = [False] * (high - low)
        count(bisect_right(at, at[low] - span), low)


FOUND = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())]))
FOUND_DDL = "array<struct<license: string, first_word: long, words: long, containment: double>>"


def merged(places: list[tuple[str, int, int, float]]) -> list[dict]:
    """Places of one license that overlap become one: the longer if it is more than twice as long (a text before the notice in it), else the better; then `settled`; in text order."""
    out: list[dict] = []
    for name, at, n, c in sorted(set(places), key=lambda p: (p[0], p[1], -p[3])):
        last = out[-1] if out else None
        if last and last["license"] == name and at < last["first_word"] + last["words"]:
            m = last["words"]
            if n > 2 * m or (m <= 2 * n and (c, n) > (last["containment"], m)):
                last |= {"first_word": at, "words": n, "containment": c}
        else:
            out.append({"license": name, "first_word": at, "words": n, "containment": c})
    return sorted(settled(out), key=lambda p: (p["first_word"], p["license"]))


def settled(places: list[dict]) -> list[dict]:
    """Licenses that differ in a clause hold most of each other: of overlapping places, neither twice as long as the other, the one
    with the greater containment stays (then the longer one, then the earlier one)."""
    kept: dict[int, list[tuple[int, int]]] = {}  # by binary length: places of about one length that stay don't overlap
    out = []
    for p in sorted(places, key=lambda p: (-p["containment"], -p["words"], p["first_word"], p["license"])):
        first, n = p["first_word"], p["words"]
        near = (q for b in (n.bit_length() - 1, n.bit_length(), n.bit_length() + 1) for q in _around(kept.get(b, []), first, first + n))
        if not any(max(n, m) <= 2 * min(n, m) for _, m in near):
            insort(kept.setdefault(n.bit_length(), []), (first, n))
            out.append(p)
    return out


def _around(held: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Of sorted places that don't overlap: those that overlap [start, end)."""
    at = bisect_left(held, (start,))
    return [q for q in held[max(0, at - 1) : bisect_left(held, (end,))] if q[0] + q[1] > start]


def found(docs: DataFrame, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, licenses): the verified places of every document."""
    templates = templates if templates is not None else library()
    if sum(len(x or "") for _, x in templates) > 8 * MOST_TEMPLATES:
        raise ValueError("too many templates to send to every task")

    def each(batches):
        index, known = Templates(templates), _Hashes()
        reach = 2 * (max(index.spans, default=0) + WORDS)
        step = max(PIECE, 2 * reach)

        def flush(ids, texts):
            sizes = [len(x) for x in texts]
            first = np.cumsum([0, *sizes])
            words, owner = np.concatenate(texts), np.repeat(np.arange(len(ids)), sizes)
            places: list[list] = [[] for _ in ids]
            for start in range(0, max(1, len(words) - reach), step):
                part = slice(start, start + step + reach)
                for t, at, n, c in index.scan(words[part], owner[part]) if len(words) else ():
                    d = owner[start + at]
                    places[d].append((index.names[t], int(start + at - first[d]), n, c))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([merged(p) for p in places], FOUND)], ["doc_id", "licenses"])

        for b in batches:
            ids, texts, held = [], [], 0
            for d, x in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                words = word_hashes(x.as_py() or "", known)
                ids.append(d)
                texts.append(words)
                held += len(words)
                if held >= PIECE:
                    yield flush(ids, texts)
                    ids, texts, held = [], [], 0
            if ids:
                yield flush(ids, texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(each, f"doc_id long, licenses {FOUND_DDL}")


def digests(docs: DataFrame) -> DataFrame:
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda x: x["license"])))
    return found(docs).select("doc_id", F.size("licenses").cast("long").alias("places"), F.array_join(names, ";").alias("licenses"), F.array_max(F.transform("licenses", lambda x: x["containment"])).alias("containment"))
