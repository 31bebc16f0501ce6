"""Ranked search beside a plain one: every pair of item and document scored by itself."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from leadmill.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, top=50, once=True):
    texts = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    n_docs, n_terms, asked = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts), {}
    df = {}
    for _, t in texts:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    for i, t in items:
        asked.setdefault(i, []).extend(TERM.findall((t or "").translate(LOWER)))
    out = []
    for i, terms in asked.items():
        got = []
        for d, t in texts:
            s = 0
            for w in set(terms):
                if tf := t.count(w):
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    s += (1 if once else terms.count(w)) * weight * (1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * len(t) * n_docs // n_terms)))
            if s > 0:
                got.append((-s, d is None, d or 0))
        out += [(i, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(got)[:top])]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


def test_given_tables(spark, data):
    docs, items = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "benchmark"))
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows(ranked.digests(docs, items)) == want


@pytest.mark.parametrize("once", [True, False])
def test_edges(spark, monkeypatch, once):
    """Nulls, ties, repeated rows, repeated items, long texts in pieces, small blocks, items in many parts."""
    for name, value in {"PIECE": 64, "BLOCK": 7, "TOGETHER": 5, "MOST": 40, "SALTS": 3}.items():
        monkeypatch.setattr(ranked, name, value)
    r = random.Random(2)
    words = ["Alpha", "beta", "ÉTÉ", "été", "x1", "漢字", "the", "the", "the", "q_r", "zz\x7fy", "don't"]
    docs = [(k % 50, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 20, 200])))) for k in range(120)]
    docs += [(None, "alpha beta"), (None, "alpha beta"), (7, None), (8, ""), (9, " -- "), (1000, "alpha"), (1001, "ALPHA")]
    items = [(k, " ".join(r.choice(words) for _ in range(6))) for k in range(20)] + [(3, "漢字 x1"), (None, "alpha été"), (40, None), (41, "unknown"), (42, "The THE the alpha")]
    d = spark.createDataFrame([(*x, "e", 1) for x in docs], "doc_id long, text string, item_id string, score int").repartition(5)
    i = spark.createDataFrame([(*x, "e") for x in items], "item_id long, text string, doc_id string")
    assert rows(ranked.ranked(d, i, top=6, once=once)) == plain(docs, items, 6, once)
    assert ranked.ranked(d.where(F.lit(False)), i).collect() == [] == ranked.ranked(d, i.where(F.lit(False))).collect()
