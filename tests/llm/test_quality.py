import math
import re
import zlib

import numpy as np
import pytest
import regex

from leadmill.llm import quality


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = quality.digests(docs, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    assert ((got.score >= 0.5) == (got.predicted == 1)).all() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert 0.2 < len(held) / len(got) < 0.5 and (held.predicted == held.quality).mean() > 0.97


def test_compiled_rules_are_the_model(spark):
    rng = np.random.default_rng(0)
    x = rng.random((500, len(quality.FEATURES)))
    model = quality.fit(x, ((x[:, 2] > 0.6) & (x[:, 5] < 0.5)).astype(int))
    assert 0 < len(model.rules) < 100 and all(len(r) <= quality.DEPTH for r in model.rules)
    df = spark.createDataFrame(x.tolist(), [f"__{f}" for f in quality.FEATURES])
    got = np.array([r[0] for r in df.coalesce(1).select(model.score()).collect()])
    assert np.allclose(np.sort(got), np.sort(model.score_rows(x)))


def test_lasso_is_sparse():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2, (2000, 30)).astype(float)
    y = (rng.random(2000) < 1 / (1 + np.exp(-(4 * a[:, 3] - 2)))).astype(float)
    w, _ = quality.lasso(a, y, 0.02)
    assert abs(w[3]) > 1 and (abs(np.delete(w, 3)) < 0.2).all() and (w == 0).sum() > 20


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, "c"), (1, "", "c"), (2, "a b", "c"), (2, "a b", "c"), (4, "x " * 200_000, "c")], "doc_id long, text string, score string")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    got = quality.digests(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5} and not [r for r in got if r.doc_id is None][0].held_out
    assert quality.accepted(docs, none).columns == docs.columns and quality.accepted(docs, none).count() == 5
    assert quality.digests(docs.limit(0), none).count() == 0


def plain_statistics(text):
    words, lines, n = re.findall(r"[^\x20\x09-\x0D]+", text), text.split("\n"), len(text)
    if not text:
        return [0.0] * len(quality.FEATURES)
    k, share = max(1, len(words)), lambda pattern: len("".join(regex.findall(pattern, text))) / max(1, n)
    return [n, len(words), n / k, len(set(words)) / k, sum(a == b for a, b in zip(words, words[1:], strict=False)) / k, share(r"\p{Lu}"), share(r"[^\p{L}\p{N}\t-\r .,]"), share("[0-9]"),
            text.count("|") / n, text.count("!") / n, (text.count(".") + text.count(",")) / k, k / len(lines), len(set(lines)) / len(lines)]


def test_scores_beside_plain_python(spark):
    """Statistics counted by plain Python, rules evaluated one by one: the same score for every document."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(spark.createDataFrame([(9001, "", "x", "x", 0), (9002, " \n\t", "x", "x", 3), (9003, "é É! | 12 a a\n" * 40_000, "x", "x", 0)], docs.schema))
    model = quality.trained(docs, labels)
    want = {}
    for r in docs.collect():
        x = dict(enumerate(plain_statistics(r.text or "")))
        z = model.bias + sum(w for rule, w in zip(model.rules, model.weights, strict=True) if all((x[f] > t) == above for f, above, t in rule))
        want[r.doc_id] = 1 / (1 + math.exp(-z))
    got = {r.doc_id: r for r in quality.digests(docs, labels).collect()}
    assert set(got) == set(want) and len(set(want.values())) > 2
    for k, r in got.items():
        assert abs(r.score - want[k]) < 1e-9 and r.predicted == (want[k] >= 0.5) and r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1)
