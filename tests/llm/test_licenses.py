import random

from leadmill.llm import licenses


def brute(text, templates):
    """Names of the places that stand: best stretches of every template, then the best of overlapping ones, all pairs compared."""
    words, places = licenses.WORD.findall((text or "").lower()), []
    for name, t in templates:
        own = licenses.WORD.findall(t.lower())
        size = min(licenses.WORDS, len(own))
        shingles = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        there = [(i, s) for i in range(len(words) - size + 1) if (s := tuple(words[i : i + size])) in shingles]
        span = len(own) - size + 1
        while there:
            got, first = max((len({s for j, s in there if p <= j < p + span}), -p) for p, _ in there)
            if got < licenses.CONTAINED * len(shingles):
                break
            end = max(j for j, _ in there if -first <= j < -first + span) + size
            places.append((name, -first, end, got / len(shingles)))
            there = [(j, s) for j, s in there if j + size <= -first or j >= end]
    meets = lambda p, q: p[1] < q[2] and q[1] < p[2]
    alike = lambda p, q: max(p[2] - p[1], q[2] - q[1]) <= 2 * min(p[2] - p[1], q[2] - q[1])
    kept, places = [], [p for p in places if not any(p[0] == q[0] and meets(p, q) and q[2] - q[1] > 2 * (p[2] - p[1]) for q in places)]
    for p in sorted(places, key=lambda p: (-p[3], p[1] - p[2], p[1], p[0])):
        if not any(meets(p, q) and (p[0] == q[0] or alike(p, q)) for q in kept):
            kept.append(p)
    return {p[0] for p in kept}


def test_brute_force(spark, data):
    templates = [(k, x) for k, x in licenses.library() if len(x) < 2000]
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    r = random.Random(3)
    for _, x in templates:
        for rate in (0, 0.01, 0.03):
            words = [w if r.random() >= rate else "zzz" for w in x.split()]
            docs.append((len(docs) + 10_000, " ".join([*r.choice(docs)[1].split()[: r.randrange(300)], *words, "tail", "text"])))
    got = {x.doc_id: {p.license for p in x.licenses} for x in licenses.found(spark.createDataFrame(docs, "doc_id long, text string"), templates).collect()}
    want = {d: brute(t, templates) for d, t in docs}
    missed = sum(len(want[d] - got[d]) for d in want)
    assert sum(map(len, want.values())) > 50 and missed <= 1 and all(got[d] <= want[d] for d in want)


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, 1), (1, "", 1), (None, "All rights reserved", 1), (2, "x " * 300_000 + "Released under the MIT License.", 1), (3, "all rights", 1), (4, "reserved", 1), (5, "All rights reserved. All Rights Reserved", 1), (5, "All rights reserved. All Rights Reserved", 1)], "doc_id long, text string, licenses int").coalesce(1)
    got = [(r.doc_id, [(p.license, p.first_word, p.containment) for p in r.licenses]) for r in licenses.found(docs).collect()]
    twice = [("all-rights-reserved", 0, 1.0), ("all-rights-reserved", 3, 1.0)]
    assert got == [(None, []), (1, []), (None, [("all-rights-reserved", 0, 1.0)]), (2, [("MIT", 300_000, 1.0)]), (3, []), (4, []), (5, twice), (5, twice)]
    assert licenses.found(docs.limit(0)).count() == 0 and licenses.found(docs, [("none", "")]).where("size(licenses) > 0").count() == 0


def test_band_guarantee():
    for n in licenses.CLASSES:
        low = max(1, n // 4)
        assert (1 - low / (2 * n)) ** licenses.bands_of(n, low) <= licenses.MISS


def test_long_texts_in_pieces(monkeypatch):
    text = "Ab c_d é " * 500 + "x" * 300 + " end"
    want = licenses.word_hashes(text, licenses._Hashes()).tolist()
    monkeypatch.setattr(licenses, "TEXT_PIECE", 7)
    assert licenses.word_hashes(text, licenses._Hashes()).tolist() == want and len(want) == 2002 and len(licenses.word_hashes("", {})) == 0


def test_every_copy_is_a_place(spark):
    notice = licenses.NOTICES["MIT"][1]
    size = len(licenses.WORD.findall(notice))
    docs = []
    for gaps in ([300, 20], [300, 0], [0, 5, 90, 200], [500, 1, 1, 1]):
        parts, at, want = [], 0, []
        for g in gaps:
            parts += ["filler"] * g + [notice]
            want.append(at + g)
            at += g + size
        docs.append((len(docs), " ".join(parts), want))
    got = licenses.found(spark.createDataFrame(docs, "doc_id long, text string, want array<long>")).collect()
    for r in got:
        assert [(p.first_word, p.words, p.containment) for p in r.licenses if p.license == "MIT"] == [(w, size, 1.0) for w in docs[r.doc_id][2]]


def test_bands_of_partial_copies_and_long_templates():
    for n in licenses.CLASSES:
        for low in {max(1, n // 4), n}:
            similarity = licenses.CONTAINED * low / (2 * n + (1 - licenses.CONTAINED) * low)
            assert (1 - similarity) ** licenses.bands_of(n, low) <= licenses.MISS
    for count in (2052, 6000):  # distinct shingles of 2048 and more
        text = " ".join(f"w{i}" for i in range(count))
        words = licenses.word_hashes(f"a b c {text} d", licenses._Hashes())
        found = licenses.Templates([("long", text)]).scan(words, words * 0)
        assert licenses.merged([("long", *p[1:]) for p in found]) == [{"license": "long", "first_word": 3, "words": count, "containment": 1.0}]


def test_full_texts(spark):
    """Every full text is found as itself alone, from its first word, also with words changed; clauses tell BSD texts apart."""
    full = [(k, x) for k, x in licenses.library() if len(x) > 600 and x not in sum(licenses.NOTICES.values(), ())]
    r, docs = random.Random(8), []
    for k, x in full:
        words = x.split()
        docs.append((k, "some words before " + x))
        docs.append((k, " ".join(["before it"] + [w if r.random() > 0.01 else "zzz" for w in words] + ["and after"])))
    got = licenses.found(spark.createDataFrame([(i, x) for i, (_, x) in enumerate(docs)], "doc_id long, text string")).collect()
    assert {k for k, _ in full} >= {"MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"}
    for row in got:
        best = max(row.licenses, key=lambda p: p.words)
        assert best.license == docs[row.doc_id][0] and best.containment > 0.85 and best.first_word <= 3 + 12, (docs[row.doc_id][0], row.licenses)
        assert not {p.license for p in row.licenses if p.words > 100} - {best.license}


def test_settled():
    place = lambda name, at, n, c: {"license": name, "first_word": at, "words": n, "containment": c}
    a, b, c, d = place("A", 0, 100, 0.9), place("B", 10, 80, 1.0), place("C", 20, 5, 1.0), place("D", 95, 90, 0.95)
    assert licenses.settled([a, b, c, d]) == [b, c, d] and licenses.settled([]) == []


def test_stretches_beside_all_stretches():
    r = random.Random(12)
    for _ in range(300):
        n, span, size = r.randrange(1, 40), r.choice([3, 8, 20]), r.choice([1, 3])
        at = sorted(r.sample(range(80), n))
        ids = [r.randrange(6) for _ in at]
        need, left, want = r.choice([1, 2, 4]), list(zip(at, ids, strict=True)), []
        while left:
            got, first = max((len({s for j, s in left if p <= j < p + span}), -p) for p, _ in left)
            if got < need:
                break
            last = max(j for j, _ in left if -first <= j < -first + span)
            want.append((-first, last, got))
            left = [(j, s) for j, s in left if j + size <= -first or j >= last + size]
        assert list(licenses.stretches(at, ids, span, size, need)) == want


def test_many_copies_of_a_long_license_take_linear_time():
    """50 copies of GPL-3.0 in one document: seconds, and every place."""
    import time

    text = dict(licenses.library())["GPL-3.0"]
    one = len(licenses.WORD.findall(text))
    index, known = licenses.Templates(licenses.library()), licenses._Hashes()
    words = licenses.word_hashes(" filler between ".join([text] * 50), known)
    began = time.perf_counter()
    got = licenses.merged([(index.names[t], a, n, c) for t, a, n, c in index.scan(words, words * 0)])
    assert time.perf_counter() - began < 30
    places = [p for p in got if p["license"] == "GPL-3.0" and p["words"] > one // 2]
    assert [(p["first_word"], p["containment"]) for p in places] == [(k * (one + 2), 1.0) for k in range(50)]
