"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of whole texts are Spark expressions.  Shallow trees are grown on a bounded sample of labelled rows;
every path from a root to a node is a conjunctive rule.  Lasso logistic regression over the rules keeps a few of
them, and the kept ones are compiled into one Spark column: the corpus is scored without Python.

Labels are learned from rows whose crc32(doc_id as text) mod 3 is not 1.  Neither labels nor lang, source or doc_id are
inputs of a score.  The sample is the SAMPLE labelled rows that come first by a hash of doc_id, so it is the same
on every run; corpus size does not change it otherwise.

Defined results: null texts count as empty; an empty text has all statistics zero and is scored like any other; a
null doc_id is scored, is not held out and is never learned from; repeated rows get equal scores; without labels
of both kinds every score is the smoothed share of label 1; texts of any length are measured whole; other columns stay and
can't meet the statistics, whose names are prefixed; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

#: Labelled rows that are learned from, at most.
SAMPLE = 20_000
TREES, DEPTH, BINS, MOST_RULES, SEED = 80, 3, 24, 240, 11
FEATURES = ("chars", "words", "word_len", "distinct", "repeats", "upper", "symbols", "digits", "pipes", "bangs", "stops", "line_words", "line_distinct")

Rule = tuple[tuple[int, bool, float], ...]  # (feature, above, threshold), all of them


def statistics(docs: DataFrame, *keep: Column) -> DataFrame:
    """The columns to keep, and FEATURES of the whole text.

    They come out of a generator of one row: no later filter or sum is moved below it, where it would have them
    computed again for every rule.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*keep, t.alias("__t"), F.array_remove(F.split(t, SPACE), "").alias("__w"), F.split(t, "\n").alias("__l"))
    n, chars, w = F.greatest(F.size("__w"), F.lit(1)), F.greatest(F.length("__t"), F.lit(1)), F.col("__w")
    without = lambda pattern: F.length("__t") - F.length(F.regexp_replace("__t", pattern, ""))
    count = lambda s: F.length("__t") - F.length(F.replace("__t", F.lit(s), F.lit("")))
    made = {
        "chars": F.length("__t"),
        "words": F.size("__w"),
        "word_len": F.length("__t") / n,
        "distinct": F.size(F.array_distinct("__w")) / n,
        "repeats": F.size(F.filter("__w", lambda x, i: (i > 0) & (x == F.get(w, i - 1)))) / n,
        "upper": without(r"\p{Lu}+") / chars,
        "symbols": without(r"[^\p{L}\p{N}\s.,]+") / chars,
        "digits": without(r"[0-9]+") / chars,
        "pipes": count("|") / chars,
        "bangs": count("!") / chars,
        "stops": (count(".") + count(",")) / n,
        "line_words": n / F.size("__l"),
        "line_distinct": F.size(F.array_distinct("__l")) / F.size("__l"),
    }
    names = [c for c in base.columns if c not in ("__t", "__w", "__l")]
    values = F.struct(*[F.when(F.col("__t") == "", 0.0).otherwise(F.coalesce(made[f].cast("double"), F.lit(0.0))).alias(f"__{f}") for f in FEATURES])
    return base.select(*names, F.inline(F.array(values)))


@dataclass(frozen=True)
class Model:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self) -> Column:
        """Over the columns of `statistics`."""
        z = F.lit(self.bias)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            held = F.lit(True)
            for f, above, x in rule:
                c = F.col(f"__{FEATURES[f]}")
                held = held & ((c > x) if above else (c <= x))
            z = z + F.when(held, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + holds(self.rules, x) @ np.array(self.weights))))


def holds(rules, x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, k] *= (x[:, f] > t) if above else (x[:, f] <= t)
    return out


def tree_paths(codes: np.ndarray, y: np.ndarray, cuts: list[np.ndarray], rng: np.random.Generator) -> list[Rule]:
    """The paths of one tree, grown on a half of the rows and some of the features at each node."""
    rows = rng.permutation(len(y))[: max(2, len(y) // 2)]
    paths: list[Rule] = []

    def grow(rows: np.ndarray, path: Rule) -> None:
        if path:
            paths.append(path)
        if len(path) == DEPTH or len(rows) < 20 or y[rows].min() == y[rows].max():
            return
        best = (1e-9, None, 0)
        n, p = len(rows), y[rows].sum()
        for f in rng.permutation(len(cuts))[: len(cuts) * 2 // 3]:
            size = np.bincount(codes[rows, f], minlength=len(cuts[f]) + 1)[:-1].cumsum()
            ones = np.bincount(codes[rows, f], weights=y[rows], minlength=len(cuts[f]) + 1)[:-1].cumsum()
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = ones**2 / size + (p - ones) ** 2 / (n - size) - p**2 / n
            gain = np.where((size > 4) & (n - size > 4), gain, 0.0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
        _, f, at = best
        if f is None:
            return
        low = codes[rows, f] <= at
        for above, part in ((False, rows[low]), (True, rows[~low])):
            grow(part, (*path, (int(f), above, float(cuts[f][at]))))

    grow(rows, ())
    return paths


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an L1 penalty on all but the bias, by accelerated proximal gradient."""
    n, d = a.shape
    w = v = np.zeros(d + 1)
    a1 = np.hstack([a, np.ones((n, 1))])
    rate, t = 4 * n / max(np.linalg.norm(a1, 2) ** 2, 1e-9), 1.0
    for _ in range(steps):
        g = a1.T @ (1 / (1 + np.exp(-(a1 @ v))) - y) / n
        new = v - rate * g
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - rate * penalty, 0)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return w[:-1], float(w[-1])


def loss(p: np.ndarray, y: np.ndarray) -> float:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """x: FEATURES of the sampled rows; y: their labels, 0 or 1."""
    y = y.astype(float)
    share = (y.sum() + 1) / (len(y) + 2)
    if not len(y) or y.min() == y.max():
        return Model((), (), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(SEED)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    # Junk may be rarer than a quantile: the quantiles of either label are cuts as well.
    cuts = [np.unique(np.concatenate([c, *(np.quantile(x[y == k, f], np.linspace(0.02, 0.98, BINS // 2)) for k in (0, 1))])) for f, c in enumerate(cuts)]
    codes = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    found: dict[bytes, Rule] = {}
    for _ in range(TREES):
        for rule in tree_paths(codes, y, cuts, rng):
            key = np.packbits(holds([rule], x).astype(bool)).tobytes()
            if key not in found and 5 <= sum(map(int.bit_count, key)) <= len(y) - 5:
                found[key] = rule
    # Strongest first, by their correlation with the label.
    rules = list(found.values())
    if not rules:
        return Model((), (), float(np.log(share / (1 - share))))
    a = holds(rules, x)
    strength = np.abs((a - a.mean(0)).T @ (y - y.mean())) / np.sqrt(a.var(0) + 1e-12)
    best = np.sort(np.argsort(-strength, kind="stable")[:MOST_RULES])
    rules, a = [rules[i] for i in best], a[:, best]
    fold = rng.integers(0, 3, len(y))
    tried = []
    for penalty in (0.01, 0.003, 0.001, 0.0003):
        w, b = lasso(a[fold > 0], y[fold > 0], penalty, 200)
        tried.append((loss(1 / (1 + np.exp(-(a[fold == 0] @ w + b))), y[fold == 0]), -penalty))
    least = min(tried)[0]  # the sparsest fit that is as good as the best, but for a little
    w, b = lasso(a, y, max(-p for x, p in tried if x <= least + 0.005))
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    return Model(tuple(rules[i] for i in kept), tuple(float(w[i]) for i in kept), b)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of `labels.quality` from at most `sample` labelled rows."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("__y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)  # 12 bytes a row: at most a quarter of a megabyte
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("__y").alias("__y"))
    got = statistics(rows, F.col("doc_id"), F.col("__y")).toPandas().sort_values("doc_id")
    return fit(got[[f"__{f}" for f in FEATURES]].to_numpy(float), got["__y"].to_numpy())


def scored(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """keep, score and predicted."""
    rows = statistics(docs, *[F.col(c) for c in keep]).select(*keep, model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def digests(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, trained(docs, labels), "doc_id").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier predicts to be of label 1."""
    model = trained(docs, labels)
    whole = docs.withColumn("__row", F.struct(*docs.columns))
    return scored(whole, model, "__row").where("predicted = 1").select("__row.*")
