"""Mixing, models and licences: odd inputs, held-out accuracy, exact parts against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.llm import language, licenses, mixing, quality_rules, rule_ensemble, text_stats, toxicity
from strata.llm.common import alnum_words
from tests.llm.helpers import BLANK, corpus, docs

SF = "/root/testdata/sf0.01"
ROWS = corpus()


def _labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").selectExpr(
        "*", "'x' as text", "1 as label", "2 as n_words")


def _fold(i, mod):
    return zlib.crc32(str(i).encode()) % mod


# -- mixing -----------------------------------------------------------------------------


def _sources(spark, sizes, each=7, seed=0):
    rng = np.random.default_rng(seed)
    rows, i = [], 0
    for name, n in sizes.items():
        for _ in range(n):
            rows.append((i, " ".join(["w"] * int(rng.integers(0, 2 * each))), "en", name, 1))
            i += 1
    rows += [(None, None, None, None, None), (3, rows[3][1], "en", rows[3][3], 1), (i, "", "en", "empty", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("kw", [
    dict(entropy=0.9, max_epochs=None), dict(entropy=None, max_epochs=2.0), dict(entropy=0.999, max_epochs=3.0),
    dict(entropy=1.0, max_epochs=None, budget=500.0), dict(entropy=None, max_epochs=None)])
def test_mix_weights_and_passes(spark, kw):
    df = _sources(spark, {"a": 300, "b": 100, "c": 30, "d": 7}).selectExpr("*", "1 as tokens", "2 as epoch", "3 as w")
    got = mixing.mix(df, block_rows=16, **kw).toPandas()
    rows = df.toPandas()
    rows["n"] = [len(BLANK.findall((t or "").encode())) for t in rows.text]
    size = rows.groupby("source", dropna=False).n.sum()
    size = {("" if pd.isna(k) else k): v for k, v in size.items()}
    live = {k: v for k, v in size.items() if v > 0}
    total, a = sum(live.values()), got.exponent.iloc[0]
    z = sum((v / total) ** a for v in live.values())
    q = {k: (v / total) ** a / z for k, v in live.items()}
    entropy = -sum(x * math.log(x) for x in q.values()) / math.log(len(live))
    spend = kw.get("budget") or max(live[k] / q[k] for k in live)
    epochs = {k: q[k] * spend / live[k] for k in live}
    if kw["max_epochs"]:
        assert max(epochs.values()) <= kw["max_epochs"] * (1 + 1e-6)
    elif kw["entropy"]:
        assert entropy >= kw["entropy"] - 1e-6
    if kw["entropy"] is None and kw["max_epochs"] is None:
        assert a == 1.0
    longest = rows.n.max() * 2
    for name, own in got.groupby(got.source.fillna("")):
        if name in live:
            assert own.weight.iloc[0] == pytest.approx(q[name])
            assert own.epochs.iloc[0] == pytest.approx(epochs[name])
            assert epochs[name] * live[name] - 1e-6 <= own.n_tokens.sum() <= epochs[name] * live[name] + longest
            assert own.epoch.max() == math.ceil(epochs[name] - 1e-9) - 1
        # every whole pass holds every row; the partial pass is a prefix of its order
        for e, one in own.groupby("epoch"):
            if name not in live or e < math.floor(epochs[name] + 1e-9):
                assert len(one) == (rows.source.fillna("") == name).sum()
    if "budget" not in kw:
        assert set(got.doc_id.dropna()) == set(rows.doc_id.dropna())


def test_partial_pass_is_a_prefix_of_blocks(spark):
    df = _sources(spark, {"a": 400, "b": 90})
    got = mixing.mix(df, entropy=None, max_epochs=1.5, block_rows=8).toPandas()
    own = got[got.source == "b"]
    last = own[own.epoch == 1]
    assert 0 < len(last) < 90
    # blocks of the partial pass: all but the boundary block are whole
    keyed = df.filter("source = 'b'").withColumns({"_s": mixing._source_key(), "_h": mixing._row_hash()})
    n_blocks = F.lit(math.ceil(len(own[own.epoch == 0]) / 8)).cast("long")
    keys = keyed.select("doc_id", mixing._block_key(42, F.lit(1), n_blocks).alias("bk"),
                        mixing._row_key(42, F.lit(1)).alias("rk")).toPandas().sort_values(["bk", "rk"])
    first = keys.head(len(last))
    assert sorted(first.doc_id) == sorted(last.doc_id)


def test_apply_mix_keeps_columns_and_copies(spark):
    df = _sources(spark, {"a": 200, "b": 20}).selectExpr(
        "*", "1 as _n", "2 as epoch", "3 as whole", "4 as tokens", "5 as weight", "6 as n_blocks", "7 as rest",
        "8 as _s", "9 as _h", "'a.b' as `dot.name`")
    got = mixing.apply_mix(df, entropy=None, max_epochs=3.0, block_rows=8)
    assert got.columns == df.columns
    own = mixing.mix(df, entropy=None, max_epochs=3.0, block_rows=8)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in own.collect())


def test_mix_of_nothing(spark):
    assert mixing.mix(docs(spark, [])).collect() == []
    assert len(mixing.mix(docs(spark, [(1, None), (2, "")])).collect()) == 2


# -- language -----------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    got = language.detect(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    rows = pd.read_parquet(f"{SF}/documents.parquet").merge(got, on="doc_id")
    assert (rows.held_out == [(_fold(i, 3) == 1) for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_only_category_l_counts_as_letters(spark):
    rows = [(k, "the cat sat on the mat and was happy " * 3) for k in range(30)]
    odd = ["² ½ ③", "Ⅷ ७ _", "🙂", "ª", "ʰ 1", "日", "1 é"]
    got = {r.doc_id: r.lang_pred for r in language.detect(docs(spark, rows + [*enumerate(odd, 50)])).collect()}
    assert [got[50 + k] for k in range(len(odd))] == ["und"] * 3 + ["en"] * 4


def test_every_language_is_learned_or_the_fit_fails(spark):
    rows = [(k, f"{'abcdefghij'[k % 10] * 3} text {k}", f"l{k % 10}") for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language.fit(df, F.lit(True), max_rows=10).families.names) == 10
    with pytest.raises(ValueError, match="10 languages"):
        language.fit(df, F.lit(True), max_rows=9)


def test_language_odd_inputs(spark):
    rows = [(k, "the cat sat on the mat and was happy " * 3) for k in range(30)]
    df = docs(spark, [*rows, (50, None), (51, ""), (52, "123 !!! --"), (None, "the cat"), (3, "the mat")])
    got = {(r.doc_id, r.lang_pred, r.score) for r in language.detect(df).collect()}
    assert {(50, "und", 0.0), (51, "und", 0.0), (52, "und", 0.0), (None, "en", 1.0)} <= got
    assert language.detect(docs(spark, [])).collect() == []
    assert {r.lang_pred for r in language.detect(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    wide = df.selectExpr("*", "1 as share", "2 as n", "3 as place", "4 as x", "5 as lang_pred")
    kept = language.keep_known(wide, 0.5)
    assert kept.columns == wide.columns and kept.count() == 32


def test_languages_outside_the_table_are_families(spark):
    rng = np.random.default_rng(0)
    texts = {"qq": "aeiou", "en": "bcdfg", "de": "hjklm", "fr": "npqrs"}
    rows = [(k, " ".join("".join(rng.choice(list(a), 5)) for _ in range(20)), lang, "s", 1)
            for k, (lang, a) in enumerate([*texts.items()] * 25)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.lang_pred for r in language.detect(df).collect()}
    assert all(got[r[0]] == r[2] for r in rows)


# -- statistics, quality ---------------------------------------------------------------------


def _base(text):
    words = BLANK.findall((text or "").encode())
    windows = defaultdict(list)
    for k in range(len(words) - 4):
        windows[tuple(words[k:k + 5])].append(k)
    hit = {k + j for at in windows.values() if len(at) > 1 for k in at for j in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if BLANK.search(line.encode()):
            dup += line in seen
            seen.add(line)
    return [len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)]


def test_base_counts_equal_brute_force():
    texts = [t for _, t in ROWS] + ["a b c d e a b c d e", "x\n\nx\n x\nx", "# a\n# a", "é " * 30, "a " * 9,
                                    "a b c d e f g a b c d e f g h a b"]
    for t in texts:
        assert text_stats.text_stats(t)[:5] == _base(t)
    big = np.random.default_rng(0).integers(0, 9000, 60000)
    assert text_stats.repeated_words(np.concatenate([big, big[:50]])) == 100


def test_quality_rules_keep_good_and_catch_bad(spark):
    got = quality_rules.quality_rules(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).toPandas()
    rows = pd.read_parquet(f"{SF}/documents.parquet").merge(got, on="doc_id").merge(
        pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id", how="left")
    for t, *own in zip(rows.text, rows.n_words, rows.word_chars, rows.n_symbols, rows.n_dup_lines, rows.n_repeat_words):
        assert own == _base(t)
    assert (rows.base_failed == ((rows.n_words < 10) | (100 * rows.n_repeat_words > 20 * rows.n_words))).all()
    judged = rows[~rows.base_failed]
    assert judged[judged.quality == 1].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.2
    assert not rows[rows.base_failed].kept.any()


def test_quality_odd_inputs(spark):
    df = docs(spark, ROWS)
    for labels in (_labels(spark), _labels(spark, [(1, 1, 0), (1, 0, 1), (2, None, None), (None, 1, 1), (3, 1, 0)])):
        assert quality_rules.quality_rules(df, labels).count() == len(ROWS)
        got = rule_ensemble.quality_scores(df, labels).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        got = toxicity.toxicity_scores(df, labels).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    for run in (quality_rules.quality_rules, rule_ensemble.quality_scores, toxicity.toxicity_scores):
        assert run(docs(spark, []), _labels(spark)).collect() == []


def _auc(y, s):
    rank = pd.Series(s).rank().to_numpy()
    n = int(y.sum())
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_rule_ensemble_held_out(spark):
    got = rule_ensemble.quality_scores(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).toPandas()
    rows = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (rows.held_out == [(_fold(i, 4) == 2) for i in rows.doc_id]).all()
    held = rows[rows.held_out]
    assert _auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.95
    assert (held.predicted == held.quality).mean() > 0.95
    assert (rows.predicted == (rows.score >= 0.7)).all()


def test_compiled_rules_equal_the_model(spark):
    rng = np.random.default_rng(2)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.6) & (x[:, 2] < 0.5)).astype(float)
    rules, base, weights = rule_ensemble.train(x, y)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in x], "a double, b double, c double")
    got = [r[0] for r in df.select(rule_ensemble.compile_score(rules, base, weights, ["a", "b", "c"])).collect()]
    m = np.array([rule_ensemble.holds(r, x) for r in rules], float).T
    want = 1 / (1 + np.exp(-(base + m @ weights)))
    assert np.allclose(got, want) and len(rules) < 120
    assert ((want >= 0.5) == y).mean() > 0.97


# -- toxicity -----------------------------------------------------------------------------------


def test_toxicity_held_out(spark):
    got = toxicity.toxicity_scores(
        spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")).toPandas()
    rows = got.merge(pd.read_parquet(f"{SF}/labels.parquet"), on="doc_id")
    assert (rows.held_out == [(_fold(i, 5) == 0) for i in rows.doc_id]).all()
    assert (rows.predicted == rows.toxic).mean() > 0.93
    assert rows[rows.toxic == 0].predicted.mean() < 0.02


def test_counterfactual_penalty_clears_identity_terms():
    rng = np.random.default_rng(4)
    plain = [f"n{k}" for k in range(50)]
    own, y, gone, new = [], [], [], []
    for k in range(600):
        bad = k % 3 == 0
        words = set(rng.choice(plain, 8)) | ({"vile"} if bad and k % 2 else set())
        if bad or k % 17 == 0:
            words.add("muslim")  # mentions are correlated with abuse in the sample
        own.append(sorted({f for w in words for f in toxicity.features(w)}))
        y.append(float(bad))
        old, fresh = toxicity.swap(" ".join(sorted(words)), k)
        gone.append([f for w in old for f in toxicity.features(w)])
        new.append([f for w in fresh for f in toxicity.features(w)])
    neutral = ["the muslim neighbours came for tea"]
    score = {}
    for strength in (0.0, 20.0):
        base, weights = toxicity.train(own, np.array(y), gone, new, 1 / 3, counterfactual=strength)
        score[strength] = toxicity.Scorer(base, weights).scores(neutral)[0]
    assert score[20.0] < score[0.0] - 0.1


def test_swaps_stay_within_a_kind():
    old, fresh = toxicity.swap("the muslim and the christian", 3)
    assert sorted(old) == ["christian", "muslim"]
    assert all(w in toxicity.IDENTITY_TERMS["religion"] and w not in old[:1] for w in fresh[:1])
    assert toxicity.swap("nothing here", 2)[0] == []


# -- licences -------------------------------------------------------------------------------------


def _licensed(rows, templates, least=0.8):
    want = {}
    own = [(n, {tuple(w[k:k + 5]) for k in range(len(w) - 4)}) for n, t in templates for w in [alnum_words(t)]]
    for i, t in rows:
        w = alnum_words(t)
        shingles = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        for n, x in own:
            if x and len(x & shingles) / len(x) >= least:
                want[i, n] = max(len(x & shingles) / len(x), want.get((i, n), 0))
    return want


def test_licenses_equal_brute_force(spark):
    rows = [(i, t) for i, t in ROWS if i is not None and i not in (5, 7)]
    notices = [t for _, t in licenses.TEMPLATES]
    rows += [(200 + k, f"some words before {t} and after it") for k, t in enumerate(notices)]
    rows += [(300 + k, t) for k, t in enumerate(notices)]
    long = notices[2].split()
    rows += [(400, " ".join(long[:-3])), (401, " ".join(long[:6])), (402, f"{notices[2]} " * 3), (403, notices[0].upper())]
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan_licenses(docs(spark, rows)).collect()}
    assert got == _licensed(rows, licenses.TEMPLATES)


def test_license_templates_from_a_table(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BLOCK_WORDS", 10)
    rng = np.random.default_rng(8)
    words = [f"t{k}" for k in range(300)]
    made = [(f"L{k}", " ".join(rng.choice(words, int(rng.integers(5, 90))))) for k in range(25)]
    rows = []
    for k, (_, t) in enumerate(made):
        own = t.split()
        if k % 3 == 0 and len(own) > 40:
            own[7] = "changed"
        rows.append((k, " ".join([*rng.choice(words, 33), *own, *rng.choice(words, 50)])))
    table = spark.createDataFrame([*made, ("S", "too short"), (None, "x"), ("N", None)], "license string, text string")
    got = {(r.doc_id, r.license): r.containment for r in licenses.scan_licenses(docs(spark, rows), table).collect()}
    assert got == _licensed(rows, made)
    assert licenses.scan_licenses(docs(spark, []), table).collect() == []


def test_isolation_forest_ends_on_values_next_to_each_other():
    one = np.nextafter(1.0, 2.0)
    rows = np.array([[1.0, 0.0], [one, 0.0]] * 50 + [[1.0, 5e-324], [1.0, 0.0]] * 20)
    forest = quality_rules.IsolationForest(rows, 200, 32, 1)
    far = forest.score(np.array([[9.0, 9.0], [1.0, 0.0]]))
    assert np.isfinite(far).all()
