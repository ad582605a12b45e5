"""Quality classifier: a sparse rule ensemble on text statistics.

Boosted shallow trees are grown on a bounded, labelled sample; every path from a root to a node
is a rule, a conjunction of comparisons on statistics. A logistic model with an L1 penalty picks
and weighs rules (proximal gradient). The chosen rules and weights are compiled into one Spark
column, so that all documents are scored in the JVM; Python only computes the statistics.

Defined cases: null and empty texts have all statistics 0 and get that score; without labelled
rows the score is 0.5, with one class only it is the smoothed share of that class; repeated rows
come back once each; rows with a null doc_id are scored, are never learned from, and have a null
held_out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, stage
from .text_stats import FEATURES, labelled_sample, with_stats

LABEL_ROWS, TREES, DEPTH, PENALTY = 20_000, 40, 3, 0.002

#: A rule: comparisons (feature, cut, above); it holds if all of them hold.
Rule = tuple[tuple[int, float, bool], ...]


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, least: int) -> tuple[int, float] | None:
    """Best cut by the usual second-order gain, among up to 64 quantiles of each feature."""
    best, found = 1e-6, None
    total = g.sum() ** 2 / (h.sum() + 1.0)
    for f in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, f], np.linspace(0.01, 0.99, 64)))
        if len(cuts) < 2:
            values = np.unique(x[:, f])
            cuts = (values[1:] + values[:-1])[:64] / 2
        bins = np.searchsorted(cuts, x[:, f], side="left")  # x <= cuts[k] for bins <= k
        gs = np.cumsum(np.bincount(bins, g, len(cuts) + 1))[:-1]
        hs = np.cumsum(np.bincount(bins, h, len(cuts) + 1))[:-1]
        ns = np.cumsum(np.bincount(bins, minlength=len(cuts) + 1))[:-1]
        gain = gs ** 2 / (hs + 1.0) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1.0) - total
        gain[(ns < least) | (len(x) - ns < least)] = -1
        if len(gain) and gain.max() > best:
            best, found = float(gain.max()), (f, float(cuts[gain.argmax()]))
    return found


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int, depth: int, seed: int) -> list[Rule]:
    """Paths of boosted trees, each grown on a random half of the rows."""
    rng = np.random.default_rng(seed)
    score = np.zeros(len(y))
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        half = rng.permutation(len(y))[: max(1, len(y) // 2)]
        todo: list[tuple[Rule, np.ndarray, np.ndarray]] = [((), half, np.arange(len(y)))]
        while todo:
            rule, fit, rows = todo.pop()
            cut = _split(x[fit], g[fit], h[fit], 5) if len(rule) < depth and len(fit) >= 10 else None
            if rule:
                rules[tuple(sorted(rule))] = None
            if cut is None:
                score[rows] += 0.3 * g[fit].sum() / (h[fit].sum() + 1.0)
                continue
            for above in (False, True):
                side = lambda own: own[(x[own, cut[0]] > cut[1]) == above]
                todo.append(((*rule, (*cut, above)), side(fit), side(rows)))
    return list(rules)


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return reduce(np.logical_and, ((x[:, f] > c) == above for f, c, above in rule), np.ones(len(x), bool))


def fit_weights(m: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Lasso logistic regression by accelerated proximal gradient; the intercept is free."""
    n = len(y)
    z = np.hstack([np.ones((n, 1)), m])
    step = 4.0 * n / max(np.linalg.norm(z, 2) ** 2, 1e-9)
    w = v = np.zeros(z.shape[1])
    t = 1.0
    for _ in range(rounds):
        slope = z.T @ (1 / (1 + np.exp(-np.clip(z @ v, -30, 30))) - y) / n
        new = v - step * slope
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        v, w = new + (before - 1) / t * (new - w), new
    return float(w[0]), w[1:]


def compile_score(rules: list[Rule], base: float, weights: np.ndarray, names: list[str]) -> Column:
    """The model as a Spark column."""
    total = F.lit(float(base))
    for rule, weight in zip(rules, weights):
        tests = [F.col(names[f]) > F.lit(c) if above else F.col(names[f]) <= F.lit(c) for f, c, above in rule]
        total = total + F.when(reduce(Column.__and__, tests), F.lit(float(weight))).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY,
          seed: int = 42) -> tuple[list[Rule], float, np.ndarray]:
    if len(y) == 0:
        return [], 0.0, np.zeros(0)
    share = (y.sum() + 1) / (len(y) + 2)
    if y.min() == y.max():
        return [], float(np.log(share / (1 - share))), np.zeros(0)
    rules = grow_rules(x, y, trees, depth, seed)
    m = np.array([holds(r, x) for r in rules], float).T if rules else np.zeros((len(y), 0))
    base, weights = fit_weights(m, y, penalty)
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return [rules[k] for k in kept], base, weights[kept]


def quality_scores(
    docs: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS, threshold: float = 0.7, seed: int = 42,
) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    stats = stage(with_stats(docs), "stats")
    marked = labelled_sample(labels, "quality", crc_fold("doc_id", 4) != 2, label_rows)
    # label_rows documents at most, so they go to the statistics; of rows that share an id the least counts.
    known = stats.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct(*FEATURES)).alias("own")).select("doc_id", "label", "own.*").orderBy("doc_id").toPandas()
    rules, base, weights = train(known[FEATURES].to_numpy(float), known["label"].to_numpy(float), seed=seed)
    score = compile_score(rules, base, weights, FEATURES)
    return stats.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
