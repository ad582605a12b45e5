"""op3 and op6: whole query output against a plain version that takes one text at a time."""

from __future__ import annotations

import math
import unicodedata

import numpy as np

from strata.llm import language, rule_ensemble, toxicity

from .helpers import docs

SF = "/root/testdata/sf0.001"


def _language(model, text):
    """(language, score) by voting machine by machine."""
    if not any(unicodedata.category(c).startswith("L") for c in text or ""):
        return "und", 0.0
    x = np.append(language.vector(text), np.float32(0.3)).astype(float)

    def winner(machines):
        names, votes, log = machines.names, {}, {}
        for (a, b), w, slope in zip(machines.pairs, machines.w, machines.slope):
            p = 1 / (1 + math.exp(-slope * float(x @ w.astype(float))))
            first = a if p >= 0.5 else b
            votes[first] = votes.get(first, 0) + 1
            log[a] = log.get(a, 0.0) + math.log(p)
            log[b] = log.get(b, 0.0) + math.log(1 - p)
        if not machines.pairs:
            return 0, 1.0
        total = sum(math.exp(v) for v in log.values())
        best = max(range(len(names)), key=lambda k: (votes.get(k, 0) + math.exp(log[k]) / total / 2, -k))
        return best, math.exp(log[best]) / total

    family, p = winner(model.families)
    lang, q = winner(model.within[family])
    return model.within[family].names[lang], p * q


def test_languages_equal_a_plain_version(spark, monkeypatch):
    fitted = []
    real = language.fit
    monkeypatch.setattr(language, "fit", lambda *a, **k: fitted.append(real(*a, **k)) or fitted[-1])
    table = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "½ 12"), (10**6 + 3, "é")], "doc_id long, text string")
    whole = table.unionByName(odd, allowMissingColumns=True)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.detect(whole).collect()}
    texts = {r.doc_id: r.text for r in whole.select("doc_id", "text").collect()}
    assert set(got) == set(texts) and len({v[0] for v in got.values()}) > 3
    for i, text in texts.items():
        lang, score = _language(fitted[0], text)
        assert got[i][0] == lang and abs(got[i][1] - score) < 1e-4, (i, got[i], lang, score)


def test_toxicity_scores_equal_a_plain_version(spark, monkeypatch):
    fitted = []
    real = toxicity.Scorer
    monkeypatch.setattr(toxicity, "Scorer", lambda *a: fitted.append(a) or real(*a))
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.score, r.predicted) for r in toxicity.toxicity_scores(
        table, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    base, weights = fitted[0]
    assert weights
    for r in table.select("doc_id", "text").collect():
        hit = {f for w in toxicity.words(r.text) for f in toxicity.features(w)} & set(weights)
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, base + sum(weights[f] for f in hit)))))
        assert abs(got[r.doc_id][0] - score) < 1e-9 and got[r.doc_id][1] == (got[r.doc_id][0] >= 0.5)


def _rows_with_repeated_ids():
    rng = np.random.default_rng(4)
    text = lambda bad: " ".join(rng.choice([f"n{k}x" for k in range(40)], 12)) + (" vile muslim." if bad else " fine.")
    return [(k % 90, text(k % 3 == 0)) for k in range(270)]


def test_repeated_ids_and_row_order_do_not_move_the_models(spark):
    rows = _rows_with_repeated_ids()
    labels = spark.createDataFrame([(k, int(k % 3 == 0), int(k % 3 > 0)) for k in range(90)], "doc_id long, toxic int, quality int")
    for scores in (toxicity.toxicity_scores, rule_ensemble.quality_scores):
        one, two = (sorted((r.doc_id, round(r.score, 9)) for r in scores(docs(spark, given).repartition(parts), labels).collect())
                    for given, parts in ((rows, 2), (rows[::-1], 5)))
        assert one == two


def test_what_a_swap_takes_does_not_depend_on_the_id(spark):
    rows = [(k, "The muslim left. A gay man came.") for k in range(3)] + [(3, "no group here"), (4, "no group here")]
    marked = spark.createDataFrame([(k, 1) for k in range(5)], "doc_id long, label int")
    got = toxicity._training_rows(docs(spark, rows, extra=False), marked).collect()
    assert len({(tuple(map(bytes, r.gone)), tuple(map(bytes, r.new))) for r in got}) == 2
    many = [(1, ". ".join(f"a{k} muslim" for k in range(50)))]
    capped = toxicity._training_rows(docs(spark, many, extra=False), marked, max_sentences=8).collect()
    assert len(capped[0].gone) == len(capped[0].new) == 8
