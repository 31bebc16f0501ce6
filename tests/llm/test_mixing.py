import re

import numpy as np

from leadmill.llm import mixing


def test_knapsack_is_optimal():
    r = np.random.default_rng(0)
    for _ in range(200):
        size = np.unique(r.integers(1, 40, r.integers(1, 12)))
        have, budget = r.integers(0, 4, len(size)), int(r.integers(0, 120))
        got = mixing.knapsack(size, have, budget)
        sums = {0}
        for a, c in zip(size, have, strict=True):
            sums = {x + k * int(a) for x in sums for k in range(c + 1)}
        assert (got <= have).all() and (got >= 0).all() and int(got @ size) == max(x for x in sums if x <= budget)


def test_fitting_is_near_the_budget():
    r = np.random.default_rng(1)
    for _ in range(60):
        size = np.unique(np.concatenate([[0], r.integers(1, 60_000, r.integers(300, 900))]))
        have = r.integers(1, 50, len(size))
        budget = int(r.integers(0, int(size @ have) * 9 // 10))
        got = mixing.fitted(size, have, budget)
        assert (got <= have).all() and (got >= 0).all() and 0 <= budget - int(got @ size) < 100


def test_budgets():
    assert [round(x, 6) for x in mixing.budgets([100, 100, 100])] == [200.0, 83.333333, 166.666667]
    assert mixing.budgets([]) == [] and mixing.budgets([0, 0]) == [0.0, 0.0]
    got = mixing.budgets([5, 1000, 7, 90])
    assert abs(sum(got) - 1.5 * 1102) < 1e-6 and all(t <= 2 * s + 1e-9 for t, s in zip(got, [5, 1000, 7, 90], strict=True))


def test_operator(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = mixing.digests(docs).toPandas().merge(docs.toPandas(), on="doc_id")
    assert len(rows) == docs.count()
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", t)) == n for t, n in zip(rows.text, rows["size"], strict=True))
    assert (rows.taken <= 2 * rows["size"]).all()
    by = rows.groupby("source").agg(size=("size", "sum"), known=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (by["size"] == by.known).all() and (abs(by.taken - by.target) <= by.most).all()
    again = mixing.digests(docs.repartition(5)).toPandas().sort_values("doc_id")
    assert again.taken.tolist() == rows.sort_values("doc_id").taken.tolist()
    mix = mixing.mixture(docs.withColumn("size", docs.doc_id).withColumn("times", docs.doc_id))
    assert mix.count() == int((rows.taken // rows["size"].clip(lower=1)).sum()) and "times" in mix.columns


def test_hot_length(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'a b c' as text", "'s' as source").unionByName(spark.range(3000, 3300).selectExpr("id as doc_id", "repeat('x ', 7) as text", "'t' as source"))
    got = mixing.digests(docs).groupBy("source_size").agg({"taken": "sum", "target": "max"}).toPandas()
    assert (abs(got["sum(taken)"] - got["max(target)"]) <= 7).all()


def test_edges(spark):
    docs = spark.createDataFrame([(None, None, None), (None, None, "a b c"), (1, "a", "x"), (1, "a", "x"), (2, "a", None)], "doc_id long, source string, text string")
    got = sorted(map(tuple, mixing.digests(docs).collect()), key=str)
    assert sorted((r[1], r[2], r[4]) for r in got) == [(0, 2, 0), (0, 3, 0), (1, 2, 2), (1, 2, 2), (3, 3, 3)]
    assert mixing.mixture(docs).where("text = 'x'").count() == 4
    assert mixing.digests(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0
