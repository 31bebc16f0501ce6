"""The pipeline's stages, each on its own input, beside brute force."""

import itertools
import re
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from leadmill.llm import mixing, quality
from leadmill.llm.common import scratch


@pytest.fixture(scope="module")
def stages(spark):
    """(input rows, output rows) of every stage."""
    sf = "/root/testdata/sf0.01"
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs.collect(), after.collect(), docs.columns, after.columns
        docs = after
    return out


def test_columns(stages):
    assert [k for k, _ in pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "mixing_sources", "sharding"]
    for name, (_, _, before, after) in stages.items():
        assert after == (before if name != "sharding" else [*before, "shard", "slot"])


def test_quality(spark, stages):
    before, after, *_ = stages["quality_classifier"]
    label = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    known = [r.doc_id for r in before if r.doc_id in label]
    assert set(after) <= set(before) and sum((d in kept) == (label[d] == 1) for d in known) >= 0.98 * len(known)


def test_near_duplicates(stages):
    """The stage's definition by all pairs: links of Jaccard 0.8 over five-word shingles, the least doc_id of a component stays."""
    before, after, *_ = stages["simhash_near_dedup"]
    rows = sorted(before, key=lambda r: r.doc_id)
    sets = []
    for r in rows:
        w = r.text.encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(range(len(rows)), 2):
        if 5 * min(len(sets[a]), len(sets[b])) >= 4 * max(len(sets[a]), len(sets[b])) and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert {r.doc_id for r in after} == {r.doc_id for k, r in enumerate(rows) if find(k) == k} and len(after) < len(before)


def test_decontamination(spark, stages):
    before, after, *_ = stages["benchmark_decontamination"]
    words = lambda x: [w for w in re.split(r"[\W_]+", x.lower()) if w]
    runs = set()
    for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect():
        w = words(r.text)
        runs |= {tuple(w[k : k + 13]) for k in range(len(w) - 12)}
    leaky = set()
    for r in before:
        w = words(r.text)
        if any(tuple(w[k : k + 13]) in runs for k in range(len(w) - 12)):
            leaky.add(r.doc_id)
    assert leaky and {r.doc_id for r in after} == {r.doc_id for r in before} - leaky


def test_mixing(stages):
    before, after, *_ = stages["mixing_sources"]
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    sums, taken, longest = Counter(), Counter(), Counter()
    for r in before:
        sums[r.source] += size(r.text)
        longest[r.source] = max(longest[r.source], size(r.text))
    for r in after:
        taken[r.source] += size(r.text)
    names = sorted(sums)
    for name, target in zip(names, mixing.budgets([sums[n] for n in names]), strict=True):
        assert abs(taken[name] - target) <= longest[name]
    assert set(after) <= set(before) and max(Counter(r.doc_id for r in after).values()) <= 2


def test_sharding(stages):
    before, after, *_ = stages["sharding"]
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    by, slots = Counter(), {}
    for r in after:
        by[r.shard] += len(r.text.encode()) + 8
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(by) <= set(range(24)) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(by.values()) - min(by.values()) <= 3 * max(len(r.text.encode()) + 8 for r in after)


def test_run(spark, data):
    rows = pipeline.run(spark, data)
    assert rows.columns[-2:] == ["shard", "slot"] and 0 < rows.count()
    assert quality.SAMPLE >= 1000


@pytest.mark.parametrize("rows", [0, 1])
def test_runs_over_empty_tables_and_nulls(spark, tmp_path, rows):
    """The whole pipeline over a table without rows, and over one with nulls in every column, empty, long and repeated texts."""
    text = " ".join(f"word{k % 50}" for k in range(3000))
    odd = [(None, None, None, None, None), (None, "", "en", "a", 0), (1, None, "en", None, None), (2, "two words", None, "b", 9), (2, "two words", None, "b", 9), (3, text, "en", "b", len(text)), (4, text + " end", "en", "c", None)] * rows
    spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    out = pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    got = out.collect()
    assert {(r.doc_id, r.text) for r in got} <= {x[:2] for x in odd} and all(0 <= r.shard < 24 for r in got)
