import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from leadmill.llm import linededup


def brute(docs, least):
    """Words that lie in a run of `least` words or more that also occurs earlier: every pair of places, extended while the words agree."""
    h = lambda t: int(np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).view(np.int64))
    rows = sorted({(d, t or "") for d, t in docs}, key=lambda x: (x[0] is None, x[0] or 0, h(x[1])))
    words = [t.split() for _, t in rows]
    gone = [set() for _ in rows]
    for y, b in enumerate(words):
        for x in range(y + 1):
            a = words[x]
            for i in range(len(a)):
                for j in range(i + 1 if x == y else 0, len(b)):
                    if i and j and a[i - 1] == b[j - 1]:
                        continue  # not the left end of a maximal match
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if n >= least:
                        gone[y] |= set(range(max(j, i + least) if x == y else j, j + n))
    return dict(zip(rows, gone, strict=True))


def check(frame, docs, least):
    got, want = linededup.deduplicated(frame, least).collect(), brute(docs, least)
    assert len(got) == len(docs)
    for x in got:
        gone, words = want[x.doc_id, x.original or ""], (x.original or "").split()
        assert {i for r in x.removed for i in range(r.start, r.end)} == gone
        assert (x.text or "").split() == [w for i, w in enumerate(words) if i not in gone]
        assert (x.n_words, x.removed_words) == (len(words), len(gone))
        assert gone or x.text == x.original
    return got


@pytest.mark.parametrize("seed", range(4))
def test_brute_force(spark, seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(linededup, "LINE", (1, 3, 5, 8)[seed])
    pool = [" ".join(r.choice("abcdefgh") for _ in range(r.randrange(1, 12))) for _ in range(8)]
    docs = [(r.choice([None, *range(50)]), r.choice(["", " ", "\n"]) + r.choice("\n ").join(r.choice(pool) for _ in range(r.randrange(1, 9)))) for _ in range(45)]
    docs += [(None, None), (5, ""), *docs[:4], (6, "a b " * 20), (7, "x " * 30), (8, "y " + "x " * 12)]
    frame = spark.createDataFrame([(d, t, t, 0, 0) for d, t in docs], "doc_id long, text string, original string, n_words int, h int")
    check(frame, docs, 8)


def test_long_texts_in_pieces(spark, monkeypatch):
    r = random.Random(5)
    monkeypatch.setattr(linededup, "PIECE", 100)
    monkeypatch.setattr(linededup, "TOGETHER", 40)
    monkeypatch.setattr(linededup, "LINE", 4)
    base = [f"w{r.randrange(300)}" for _ in range(300)]
    docs = [(1, " ".join(base)), (2, " ".join([*base[40:140], "new", *base[141:290]])), (3, " ".join(["own"] * 3 + base[7:19] + base[100:112])), (4, "x" * 500 + " " + " ".join(base[:30]))]
    got = check(spark.createDataFrame([(d, t, t) for d, t in docs], "doc_id long, text string, original string"), docs, 10)
    assert {x.doc_id: [tuple(s) for s in x.removed] for x in got} == {1: [], 2: [(0, 100), (101, 250)], 3: [(3, 27)], 4: [(1, 31)]}


def test_fingerprints():
    r = random.Random(1)
    for _ in range(200):
        lines, width = np.array([r.randrange(6) for _ in range(r.randrange(1, 40))], np.uint64), r.randrange(1, 9)
        got = linededup.least_lines(lines, width)
        for i in range(len(lines) - width + 1):
            own = lines[i : i + width]
            assert got[i] == i + max(k for k, x in enumerate(own) if x == own.min())


def words(name, n):
    return " ".join(f"{name}{i}" for i in range(n))


def test_runs_reach_their_ends(spark):
    """Lines of 60, 20 and 20 words are one run of 100; a passage may begin and end inside lines and be wrapped anew."""
    run = "\n".join([words("a", 60), words("b", 20), words("c", 20)])
    passage = words("p", 51).split()
    docs = [
        (1, f"{run}\n{words('x', 30)}"), (2, f"{run}\n{words('y', 30)}"), (3, f"{words('z', 9)} {' '.join(passage)} {words('u', 9)}"),
        (4, f"{words('v', 5)}\n{words('s', 3)} {' '.join(passage[:20])}\n{'  '.join(passage[20:])} {words('t', 7)}"), (5, " ".join(passage[1:50])),
    ]
    got = {r.doc_id: r for r in linededup.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[2].text == words("y", 30) and [tuple(s) for s in got[2].removed] == [(0, 100)]
    assert got[4].text == f"{words('v', 5)}\n{words('s', 3)} {words('t', 7)}" and [tuple(s) for s in got[4].removed] == [(8, 59)]
    assert not got[1].removed and not got[3].removed and not got[5].removed and got[5].text == docs[4][1]


def test_passage(spark):
    passage = "\n".join(" ".join(f"w{i}{j}" for j in range(20)) for i in range(3))
    docs = spark.createDataFrame([(i, f"own line {i}\n{passage}\nend {i}") for i in range(30)], "doc_id long, text string")
    got = {r.doc_id: r for r in linededup.deduplicated(docs).collect()}
    assert got[0].removed_words == 0 and all(got[i].text == f"own line {i}\n{i}" for i in range(1, 30))  # "end" follows everywhere, so the run takes it in
    assert linededup.deduplicated(docs.limit(0)).count() == 0
    copies = spark.createDataFrame([(i, passage) for i in (4, 4, 5)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in linededup.deduplicated(copies).collect()) == [(4, passage), (4, passage), (5, "")]


def test_long_text_and_clashing_columns(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(10**6)}" for _ in range(400_000)]
    docs = spark.createDataFrame([(2, " ".join(base), 1, 1), (1, " ".join(base[200_000:200_060]), 1, 1)], "doc_id long, text string, g int, removed int")
    got = {x.doc_id: x for x in linededup.deduplicated(docs).collect()}
    assert [tuple(s) for s in got[2].removed] == [(200_000, 200_060)] and not got[1].removed and got[2].g == 1 and got[2].n_words == 400_000


def test_words_of_many_texts_are_hashed_as_they_stand():
    """Words are equal where their hashes are, over texts side by side, long words and bytes of every kind; long texts come in pieces with a window between."""

    r = random.Random(11)
    letters = ["a", "b", "é", "漢", "\x00", " ", " ", "\n", "\t", "\xa0"]
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(300)] + ["", " ", "a" * 1000, "a" * 999, "ab" * 9]
    raw = [t.encode() for t in texts]
    cuts = np.cumsum([0, *map(len, raw)])
    h, counts = linededup.word_hashes(np.frombuffer(b"".join(raw), np.uint8), cuts[:-1])
    words = [w for x in raw for w in x.split()]
    assert counts.tolist() == [len(x.split()) for x in raw] and len({*zip(words, h.tolist(), strict=True)}) == len(set(words)) == len(set(h.tolist()))
    assert linededup.word_hashes(np.zeros(0, np.uint8), np.zeros(2, np.int64))[1].tolist() == [0, 0]


def test_pieces_of_long_texts(monkeypatch):

    text = " ".join(f"w{i}" for i in range(3000))
    whole = [g[3] for g in linededup.word_groups(pa.array(["x y", text, None, "z"]), 50)]
    monkeypatch.setattr(linededup, "PIECE", 700)
    got = list(linededup.word_groups(pa.array(["x y", text, None, "z"]), 50))
    assert [g[0].tolist() for g in got][0] == [0] and got[-1][0].tolist() == [2, 3] and len(got) > 10
    want = np.concatenate(whole)[2:-1]
    for rows, offsets, counts, words in got[1:-1]:
        assert rows.tolist() == [1] and words.tolist() == want[offsets[0] : offsets[0] + counts[0]].tolist()
    ends = [(int(o[0]), int(o[0] + c[0])) for _, o, c, _ in got[1:-1]]
    assert ends[0][0] == 0 and ends[-1][1] == 3000 and all(b[0] == a[1] - 49 for a, b in zip(ends, ends[1:], strict=False))


def test_columns_of_any_name_stay(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x", "y"), (2, " ".join(map(str, range(60))), 2, "x", "y"), (3, " ".join(map(str, range(60))), 3, "x", "y")], "doc_id int, text string, __d int, spans string, `row.h` string")
    got = linededup.deduplicated(docs)
    assert got.columns == [*docs.columns, "n_words", "removed_words", "removed"]
    assert sorted((r.doc_id, r.text[:3], r["__d"], r.spans, r["row.h"], r.removed_words) for r in got.collect()) == [(1, "a b", 1, "x", "y", 0), (2, "0 1", 2, "x", "y", 0), (3, "", 3, "x", "y", 60)]
