"""Token counts beside the library whose vocabulary they read."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadmill.llm import tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_file())
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_documents(spark, data, library):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = {r.doc_id: r for r in tokens.token_counts(docs).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        g, n = got[r.doc_id], library(r.text)
        assert (g.n_bytes, g.n_tokens, g.over_limit) == (len(r.text.encode()), n, n > 2048)


ODD = ["<|startoftext|>", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|", "'s", "'LL", "n't", "ΟΔΟΣ", "ΣΑΣ", "İstanbul", "é", "é", "ẛ̣", "̈", "\xa0", " ", "\x1c", "\x85", "漢字かな", "👩‍👩‍👧", "٣٤½", "ﬁ", "Å", "Å", "힣", "q" * 40, "in" * 30, "\x00", "​", "’s", "_", "\t", "\n", "  "]


def test_random_texts(library):
    r, count = random.Random(5), tokens.Counter(tokens.merges(tokens.default_file()))
    for _ in range(3000):
        x = "".join(r.choice([r.choice(ODD), r.choice("abcdefghijklmnopqrstuvwxyzABCDEFXYZ0123456789'!? .-"), chr(r.randrange(32, 0x2FFF)), " "]) for _ in range(r.randrange(40)))
        assert sum(sum(count([w])) for w, _ in tokens.pieces(x.encode())) == library(x), repr(x)


def test_rounds_and_lists_of_places_agree(library):
    r, m = random.Random(6), tokens.merges(tokens.default_file())
    count = tokens.Counter(m)
    for n in (1, 2, 3, 257, 300, 5000):
        for letters in ("a", "ab", "etaoin", "abcdefghijklmnopqrstuvwxyz"):
            x = "".join(r.choice(letters) for _ in range(n)).encode()
            s = count.symbols(x, np.array([len(x)]))
            want = library(x.decode())
            assert tokens.merged_long(s.copy(), m) == want == tokens.merged(s, np.zeros(len(s), np.int64), 1, m)[0]


def test_edges(spark, library, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 1000)
    long = "Wörter, die's gibt; and 12 of them <|endoftext|> " * 3000
    rows = [(1, None, "x"), (2, "", "x"), (None, "two words", "x"), (3, long, "x"), (3, long, "x"), (4, " \n\t ", "x"), (5, "漢字" * 20_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(docs).collect())
    assert got == sorted((d or 0, len((t or "").encode()), library(t), library(t) > 2048) for d, t, _ in rows)
    assert tokens.token_counts(docs.where(F.lit(False))).collect() == []
