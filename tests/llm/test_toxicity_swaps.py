"""op6: every sentence that names a group is swapped, and what that does at the registered strength."""

import inspect

import numpy as np

from strata.llm import toxicity

from .helpers import docs


def test_every_naming_sentence_is_swapped(spark):
    text = "The muslim left. Nothing here! A gay man came\nand two blind women. muslim"
    rows = docs(spark, [(1, text), (2, "none of them. here"), (3, None)], extra=False)
    marked = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, label int")
    got = {r.doc_id: r for r in toxicity._training_rows(rows, marked).collect()}
    assert len(got[1].gone) == len(got[1].new) == 4
    gone = {f for x in got[1].gone for f in np.frombuffer(x, "<i4").tolist()}
    assert gone == {f for w in ("muslim", "gay", "man", "blind", "women") for f in toxicity.features(w)}
    assert [len(got[k].new) for k in (2, 3)] == [1, 1] and not any(got[2].gone + got[3].gone)


def test_neutral_mentions_score_lower_at_the_registered_strength(spark):
    strength = inspect.signature(toxicity.toxicity_scores).parameters["counterfactual"].default
    assert strength == 1.0
    rng = np.random.default_rng(3)
    plain = [f"n{k}x" for k in range(60)]
    groups = ["muslim", "gay", "deaf", "elderly"]
    rows, labels = [], []
    for k in range(1500):
        bad = k % 3 == 0
        sentences = [" ".join(rng.choice(plain, 5)) for _ in range(4)]
        if bad or k % 17 == 0:  # mentions go with abuse in the sample, each in a sentence of its own
            sentences = [f"{s} {g}" for s, g in zip(sentences, groups)]
        if bad and k % 2:
            sentences.append("vile")
        rows.append((k, ". ".join(sentences)))
        labels.append((k, int(bad), 1))
    neutral = [(5000 + k, ". ".join(f"{' '.join(rng.choice(plain, 5))} {g}" for g in groups)) for k in range(20)]
    table = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    score = {}
    for s in (0.0, strength):
        got = toxicity.toxicity_scores(docs(spark, rows + neutral), table, counterfactual=s).collect()
        score[s] = np.array([r.score for r in sorted(got, key=lambda r: r.doc_id) if r.doc_id >= 5000])
    assert (score[0.0] >= 0.5).all(), score
    assert (score[strength] < 0.5).all(), score
