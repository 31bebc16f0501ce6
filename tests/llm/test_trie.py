"""The trie beside one of plain dictionaries."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from leadmill.llm import trie


def rebuilt(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return own, {c: own.get(c - int(math.fmod(c, 5)), [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def plain(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) or 1
        saved[p] = saved.get(p, 0) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        if p:
            leaves[p[:-1]] = leaves.get(p[:-1], 0) + leaves[p]
            saved[p[:-1]] = saved.get(p[:-1], 0) + saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r[c] for c in trie.NODES) for r in df.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, depth int, w int, low int"


def frame(spark, data):
    return spark.createDataFrame([(*x, 1, 2, 3) for x in data], SCHEMA).repartition(3)


def test_given_table(spark, data):
    t = spark.read.parquet(f"{data}/conversations.parquet")
    assert rows(trie.digests(t)) == plain(rebuilt([(r.conv_id, r.turn, r.role, r.text) for r in t.collect()])[1])


@pytest.mark.parametrize("small", [{}, {"LOCAL": 2, "CHUNK": 3}, {"LOCAL": 1, "LOCAL_TURNS": 4, "SEGMENT": 2, "CHUNK": 2}, {"SEGMENT": 3}])
def test_edges(spark, monkeypatch, small):
    """Nulls, tied turns, repeated rows, copies, absent first conversations, long conversations that share segments, small bounds."""
    for name, value in small.items():
        monkeypatch.setattr(trie, name, value)
    r = random.Random(9)
    said = [("user", "a"), ("assistant", "é" * 5), ("user", ""), (None, None), ("system", "b:c"), ("syste", "mb:c")]
    data = []
    for c in [*range(40), 71, 72, 103, -3, -5]:
        for t in range(r.choice([1, 2, 3, 9, 12])):
            data.append((c, t if r.random() < 0.9 else None, *(said[t % 3] if r.random() < 0.8 else r.choice(said))))
    data += [(200 + k, t, "user", f"long {t}") for k in range(3) for t in range(20 + (k == 2))]
    data += [(300 + k, t, "user", f"same {t % 4}") for k in (0, 1, 5, 10) for t in range(15)]
    data += [(401, 0, "user", "x" * 20_000)] * 2 + [(None, 0, "user", "nobody"), (402, 0, "user", None)]
    own, new = rebuilt(data)
    assert any(not v for v in new.values())
    t = frame(spark, data)
    assert rows(trie.digests(t)) == plain(new)
    assert rows(trie.conversation_trie(t)) == plain(own)


def test_one_conversation_and_none(spark):
    t = frame(spark, [(5, k, "user", str(k)) for k in range(7)])
    assert rows(trie.conversation_trie(t)) == plain({5: [("user", str(k)) for k in range(7)]})
    assert trie.digests(t.where(F.lit(False))).collect() == []


def test_copies_are_one_sequence(spark, monkeypatch):
    """However many conversations are equal, the sequences that are dealt do not grow."""
    t = turns = trie.turns(frame(spark, [(c, k, "user", str(k)) for c in range(500) for k in range(3)]))
    seqs, _ = trie.sequences(t.select("conv_id").distinct(), turns)
    assert [(r.w, r.low, len(r.ids)) for r in seqs.collect()] == [(500, 0, 3)]
