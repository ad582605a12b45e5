"""Quality rules: an isolation forest on rule statistics, its threshold calibrated on labels.

The base rule fails documents with fewer than 10 words or over 20 % of words in repeated 5-word
windows. For the rest, an isolation forest judges the statistics: in trees of random splits,
anomalous rows are isolated after few splits, so a short mean path means a high anomaly score
2^(-path / c). Each tree is grown on ``TREE_ROWS`` rows, drawn for it by a hash from all documents
that pass the base rule; every document is scored by the same forest.
The threshold is calibrated on all labelled rows, from the counts of good and bad ones per score:
it makes the share of bad rows that fail, less ``cost`` times the share of good rows that fail, as
large as can be. Shares of short texts vary by chance alone, so each is drawn to the median of all
rows that pass the base rule, as if ``PRIOR_WORDS`` words of typical text were added.

Defined cases: null and empty texts have 0 words and fail the base rule; repeated rows come back
once each with equal verdicts; without labelled rows, or if they are all bad, nothing but the base
rule fails; null doc_ids are judged and count for the medians but grow no tree; equal rows grow a tree
as one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Shared, map_rows, stage
from .text_stats import BASE, labelled, with_stats

#: Statistics the forest sees: shares, not sizes, so long documents are no anomaly; repeats are
#: the base rule's business.
SEEN = ["symbol_share", "upper_share", "bang_share", "pipe_share", "word_len", "stop_share"]
PRIOR_WORDS = 30
TREES, TREE_ROWS = 200, 256
#: Cells that a step of ``medians`` divides the values of a statistic into, as a power of two.
CELL_BITS = 10


def _mean_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among n rows."""
    n = np.maximum(np.asarray(n, float), 1.0)
    more = np.maximum(n - 1, 1e-9)
    return np.where(n > 2, 2 * (np.log(more) + 0.5772156649) - 2 * more / n, np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Trees as arrays: feature (-1 in a leaf), cut, left child, right child, path length so far."""

    def __init__(self, rows: np.ndarray, trees: int, tree_rows: int, seed: int) -> None:
        rng = np.random.default_rng(seed)
        self.size = min(tree_rows, len(rows))
        self.trees = [self._grow(rows[rng.choice(len(rows), self.size, replace=False)], rng) for _ in range(trees)]

    @classmethod
    def of_samples(cls, samples: list[np.ndarray], seed: int) -> IsolationForest:
        """One tree for each of ``samples``."""
        own = cls(np.empty((0, 0)), 0, 0, seed)
        rng = np.random.default_rng(seed)
        own.size = max(map(len, samples))
        own.trees = [cls._grow(rows, rng) for rows in samples]
        return own

    @staticmethod
    def _grow(rows: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, ...]:
        most = math.ceil(math.log2(max(2, len(rows))))
        nodes: list[list[float]] = []

        def grow(own: np.ndarray, depth: int) -> int:
            at = len(nodes)
            low, high = own.min(axis=0), own.max(axis=0)
            varied = np.flatnonzero(high > low)
            nodes.append([-1, 0.0, 0, 0, depth + float(_mean_path(len(own)))])
            if depth < most and len(own) > 1 and len(varied):
                f = int(rng.choice(varied))
                cut = float(rng.uniform(low[f], high[f]))
                left = own[:, f] <= cut
                if left.any() and not left.all():  # rounding may put the cut on the upper end
                    nodes[at][:2] = [f, cut]
                    nodes[at][2] = grow(own[left], depth + 1)
                    nodes[at][3] = grow(own[~left], depth + 1)
            return at

        grow(rows, 0)
        table = np.array(nodes)
        return (table[:, 0].astype(np.int64), table[:, 1], table[:, 2].astype(np.int64),
                table[:, 3].astype(np.int64), table[:, 4])

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1); about 0.5 and less is normal."""
        total = np.zeros(len(rows))
        for feature, cut, left, right, path in self.trees:
            at = np.zeros(len(rows), np.int64)
            go = np.flatnonzero(feature[at] >= 0)
            while len(go):
                own = at[go]
                at[go] = np.where(rows[go, feature[own]] <= cut[own], left[own], right[own])
                go = go[feature[at[go]] >= 0]
            total += path[at]
        return 2.0 ** (-total / len(self.trees) / max(float(_mean_path(self.size)), 1e-9))


class Judge:
    """The forest with the medians that short texts are drawn to."""

    def __init__(self, centre: np.ndarray, samples: list[tuple[np.ndarray, np.ndarray]], seed: int) -> None:
        """``samples``: (words, statistics) of the rows of each tree."""
        self.centre = centre
        self.forest = IsolationForest.of_samples([self._drawn(*s) for s in samples], seed)

    def _drawn(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        share = (words / (words + PRIOR_WORDS))[:, None]
        return self.centre + (rows - self.centre) * share

    def score(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.forest.score(self._drawn(words, rows))


def medians(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """Exact medians over all rows of columns that are never negative. Each step counts rows per cell
    of 2^-level (exact in binary) and goes on with the cell that holds the middle, until it holds one
    value only; a few thousand counts a step reach the driver."""
    first = rows.agg(F.count("*"), *[F.max(c) for c in columns]).first()
    n, rank = first[0], (first[0] - 1) // 2
    bounds = {c: (0.0, math.inf, 0) for c in columns}  # cell [low, high) and the rows below it
    level = {c: CELL_BITS - math.ceil(math.log2(m)) if m else 0 for c, m in zip(columns, first[1:])}
    middle: dict[str, tuple[float, int]] = {}  # value and the rows up to it
    while bounds:
        cells = [F.when((F.col(c) >= low) & (F.col(c) < high), F.struct(
            F.lit(c).alias("name"), F.floor(F.col(c) * 2.0 ** level[c]).alias("cell"), F.col(c).alias("value")))
            for c, (low, high, _) in bounds.items()]
        counts = rows.select(F.explode(F.filter(F.array(*cells), lambda x: x.isNotNull())).alias("x")).groupBy(
            "x.name", "x.cell").agg(F.count("*").alias("n"), F.min("x.value").alias("low"),
                                    F.max("x.value").alias("high")).orderBy("name", "cell").collect()
        for r in counts:
            if r["name"] not in bounds or r["name"] in middle:
                continue
            low, high, below = bounds[r["name"]]
            if below + r["n"] <= rank:
                bounds[r["name"]] = (low, high, below + r["n"])
            elif r["low"] == r["high"]:
                middle[r["name"]] = (r["low"], below + r["n"])
            else:
                at = level[r["name"]]
                bounds[r["name"]] = (r["cell"] * 2.0 ** -at, (r["cell"] + 1) * 2.0 ** -at, below)
                level[r["name"]] = at + CELL_BITS
                middle[r["name"]] = (math.nan, 0)  # found for this step
        bounds = {c: b for c, b in bounds.items() if math.isnan(middle[c][0])}
        middle = {c: m for c, m in middle.items() if not math.isnan(m[0])}
    # of an even number of rows, the two in the middle count; the upper may be the next value
    upper = rows.agg(*[F.min(F.when(F.col(c) > middle[c][0], F.col(c))) for c in columns]).first()
    return np.array([v if n % 2 or upto > n // 2 else (v + u) / 2
                     for (v, upto), u in zip((middle[c] for c in columns), upper)])


def tree_rows(rows: DataFrame, trees: int, each: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(words, statistics) of ``each`` rows for every tree: those with the smallest hashes of (tree,
    row) among all distinct rows. Spark keeps hashes under a bound that about ``each`` and ten standard
    deviations more stay below."""
    row = rows.filter("doc_id is not null").select(
        F.xxhash64(F.lit(seed), "doc_id", "n_words", *SEEN).alias("row"), "n_words", *SEEN)
    n = row.select("row").distinct().count()
    if n < 2:
        return []
    most = int(min(1.0, (each + 10 * math.sqrt(each)) / n) * (2 ** 63 - 1024))
    most = 2 ** 63 - 1 if n <= each + 10 * math.sqrt(each) else most

    def place(tree: F.Column) -> F.Column:
        return F.shiftrightunsigned(F.xxhash64(tree, "row"), 1)

    taken = row.withColumn("tree", F.explode(F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: place(t) <= F.lit(most)))).withColumn(
        "place", place(F.col("tree"))).distinct().toPandas()  # trees x (each + a little) rows
    taken = taken.sort_values(["tree", "place", "row"])
    return [(own["n_words"].to_numpy(float), own[SEEN].to_numpy(float))
            for _, own in taken.groupby("tree").head(each).groupby("tree")]


def calibrate(known: DataFrame, cost: float) -> float:
    """Threshold (scores above it fail) with the most bad rows failed less ``cost`` x good ones.

    ``known(anomaly, label, n)`` counts rows. Counts per score are range-partitioned by score;
    running counts start from the sums of the partitions before (one row each)."""
    spark = known.sparkSession
    per = known.groupBy("anomaly").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("bad"))
    per = stage(per.repartitionByRange("anomaly").withColumn("part", F.spark_partition_id()), "cuts")
    parts = per.groupBy("part").agg(
        F.min("anomaly").alias("least"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("least").collect()
    good, bad = sum(r["good"] for r in parts), sum(r["bad"] for r in parts)
    if not good or not bad:
        return 1.0
    before, good_so_far, bad_so_far = [], 0, 0
    for r in parts:
        before.append((r["part"], good_so_far, bad_so_far))
        good_so_far, bad_so_far = good_so_far + r["good"], bad_so_far + r["bad"]
    starts = spark.createDataFrame(before, "part int, good_before long, bad_before long")
    upto = Window.partitionBy("part").orderBy("anomaly").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lost = 1 - (F.col("good_before") + F.sum("good").over(upto)) / F.lit(good)
    caught = 1 - (F.col("bad_before") + F.sum("bad").over(upto)) / F.lit(bad)
    gains = per.join(F.broadcast(starts), "part").select("anomaly", (caught - cost * lost).alias("gain"))
    best = -gains.agg(F.max(F.struct("gain", (-F.col("anomaly")).alias("down"))).alias("best")).first()["best"]["down"]
    after = per.filter(F.col("anomaly") > F.lit(best)).agg(F.min("anomaly")).first()[0]
    return 1.0 if after is None else (best + after) / 2


def quality_rules(
    docs: DataFrame, labels: DataFrame, cost: float = 20.0, trees: int = TREES, seed: int = 42,
) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the anomaly score with its threshold."""
    stats = stage(with_stats(docs).withColumn(
        "base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words")), "stats")
    passing = stats.filter("not base_failed").select("doc_id", "n_words", *SEEN)
    samples = tree_rows(passing, trees, TREE_ROWS, seed)
    if not samples:
        return stats.select("doc_id", *BASE, "base_failed", (~F.col("base_failed")).alias("kept"),
                            F.lit(0.0).alias("anomaly"), F.lit(1.0).alias("threshold"))
    shared = Shared(docs.sparkSession, Judge(medians(passing, SEEN), samples, seed))

    def run(rows: dict[str, list]) -> dict[str, list]:
        out = {c: rows[c] for c in ("doc_id", *BASE, "base_failed")}
        seen = np.array([rows[c] for c in SEEN], float).T.reshape(-1, len(SEEN))
        out["anomaly"] = shared.get().score(np.array(rows["n_words"], float), seen)
        return out

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in BASE), "base_failed boolean", "anomaly double"])
    scored = stage(map_rows(stats.withColumn("_text", F.lit("")), run, schema, text="_text"), "scored")
    # equal rows are counted before the join, so that a repeated document is one row of it
    judged = scored.filter("not base_failed and doc_id is not null").groupBy("doc_id", "anomaly").agg(
        F.count("*").alias("n"))
    threshold = calibrate(judged.join(labelled(labels, "quality"), "doc_id"), cost)
    return scored.select("doc_id", *BASE, "base_failed",
                         F.expr(f"not base_failed and anomaly <= {threshold!r}D").alias("kept"),
                         "anomaly", F.lit(threshold).alias("threshold"))
