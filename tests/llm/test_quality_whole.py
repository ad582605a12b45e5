"""op5: medians and threshold cover all rows, each tree draws from all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import quality_rules as q


def _cut(scores, labels, cost):
    good, bad = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    if not len(good) or not len(bad):
        return 1.0
    cuts = np.unique(np.append(good, bad))
    lost = 1 - np.searchsorted(good, cuts, side="right") / len(good)
    caught = 1 - np.searchsorted(bad, cuts, side="right") / len(bad)
    best = int(np.argmax(np.append(caught - cost * lost, 0.0)))
    return float((cuts[best] + cuts[best + 1]) / 2) if best + 1 < len(cuts) else 1.0


def test_threshold_covers_every_labelled_row(spark):
    word = "translate(conv(pmod(xxhash64(id, k), 1048576), 10, 32), '0123456789', 'aeioustrnl')"
    mark = "if(pmod(xxhash64(id, k, 'm'), 4 + id % 9) = 0, '! | ', ' ')"
    rows = spark.range(30_000).selectExpr(
        "id as doc_id", f"array_join(transform(sequence(1, cast(15 + id % 20 as int)), k -> {word} || {mark}), ' ') as text")
    labels = spark.range(30_000).selectExpr("id as doc_id", "cast(id % 9 > 2 or id % 101 = 0 as int) as quality")
    got = q.quality_rules(rows, labels, trees=20).toPandas().merge(labels.toPandas(), on="doc_id")
    judged = got[~got.base_failed]
    assert len(judged) > 25_000
    want = _cut(judged.anomaly.to_numpy(), judged.quality.to_numpy(), 20.0)
    assert want < 1.0 and set(got.threshold) == {want}
    assert (got.kept == (~got.base_failed & (got.anomaly <= want))).all()


@pytest.mark.parametrize("n", [1, 2, 401, 1000])
def test_medians_are_exact(spark, n):
    rng = np.random.default_rng(n)
    data = pd.DataFrame({"a": rng.integers(0, 3, n) / 7, "b": rng.random(n) * 1e-3, "c": rng.integers(1, 90, n) / 11,
                         "d": np.zeros(n), "e": np.where(rng.random(n) < 0.01, 1e7, rng.random(n))})
    got = q.medians(spark.createDataFrame(data), list(data.columns))
    assert got.tolist() == np.median(data.to_numpy(), axis=0).tolist()


@pytest.mark.parametrize("cost", [0.5, 20.0])
def test_cut_equals_brute_force_with_ties_and_repeats(spark, cost):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 2, 3000)
    scores = np.round(rng.random(3000) * np.where(labels == 1, 0.7, 1.0), 3)
    data = spark.createDataFrame(pd.DataFrame({"anomaly": scores, "label": labels, "n": 1}))
    assert q.calibrate(data, cost) == _cut(scores, labels, cost)
    assert q.calibrate(data.filter("label = 1"), cost) == 1.0


def test_trees_draw_from_all_rows(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(9).alias("n_words"), *[
        F.col("id").cast("double").alias(c) for c in q.SEEN])
    drawn = q.tree_rows(rows.unionByName(rows.limit(500)), 60, 256, 1)
    assert [len(s) for _, s in drawn] == [256] * 60
    assert all(len(np.unique(s[:, 0])) == 256 for _, s in drawn)
    assert len(np.unique(np.concatenate([s[:, 0] for _, s in drawn]))) > 8192
