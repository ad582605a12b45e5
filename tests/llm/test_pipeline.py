"""The pipeline stage by stage against brute force, and its registration."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import corpus_pipeline
from strata.llm import language
from strata.llm.common import crc_fold, stage
from tests.llm.helpers import corpus, docs
from tests.llm.test_documents import _components, _contaminated, _fingerprint, _sorted, _tokens

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_decide_as_their_operators(spark, tmp_path):
    rows = [(i, t) for i, t in corpus(11, 80)]
    df = docs(spark, rows, extra=False)
    bench = [(k, next(t for i, t in rows if i == k)) for k in (3, 9, 20)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "near_dedup", "decontamination", "mixing", "tokens"]

    one = stage(steps["language_id"](spark, df, str(tmp_path)), "t1")
    assert one.columns == COLUMNS
    letter = lambda t: any(unicodedata.category(c).startswith("L") for c in t or "")
    assert Counter(r.doc_id for r in one.collect()) == Counter(i for i, t in rows if letter(t))

    two = stage(steps["near_dedup"](spark, one, str(tmp_path)), "t2")
    left = [(r.doc_id, r.text) for r in one.collect()]
    groups: dict[int, set] = {}
    for (i, t), root in zip(left, _components([_fingerprint(t) for _, t in left], list(range(len(left))))):
        groups.setdefault(root, set()).add((i if i is not None else 1 << 62, t))
    assert two.columns == COLUMNS
    kept = [(r.doc_id if r.doc_id is not None else 1 << 62, r.text) for r in two.collect()]
    assert len(kept) == len(groups)  # one row of each group, with its smallest id
    assert all(sum(k in g and k[0] == min(g)[0] for k in kept) == 1 for g in groups.values())

    three = stage(steps["decontamination"](spark, two, str(tmp_path)), "t3")
    verdict = _contaminated([(r.doc_id, r.text) for r in two.collect()], bench)
    assert three.columns == COLUMNS
    assert _sorted([r.doc_id for r in three.collect()]) == _sorted([v[0] for v in verdict if not v[5]])

    four = stage(steps["mixing"](spark, three, str(tmp_path)), "t4")
    assert four.columns == COLUMNS
    assert set(r.doc_id for r in four.collect()) == set(r.doc_id for r in three.collect())

    five = steps["tokens"](spark, four, str(tmp_path))
    _, want = _tokens([(r.doc_id, r.text) for r in four.collect()])
    assert _sorted(tuple(r) for r in five.collect()) == _sorted(want)
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert _sorted(tuple(r) for r in whole.collect()) == _sorted(want)


def test_stages_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = docs(spark, [], extra=False)
    for name, step in corpus_pipeline.STAGES:
        df = stage(step(spark, df, str(tmp_path)), name)
        assert df.count() == 0


def test_every_operator_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert "pipeline" in names
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 14))


def test_language_model_reads_no_metadata(spark):
    df = docs(spark, corpus())
    model = language.fit(df.filter("doc_id is not null"), crc_fold("doc_id", 3) != 1)
    moved = df.selectExpr("doc_id + 1 as doc_id", "text", "'zz' as lang", "'q' as source")
    a = sorted((r.lang_pred, r.score) for r in language.predict(df, model).collect())
    assert a == sorted((r.lang_pred, r.score) for r in language.predict(moved, model).collect())


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = docs(spark, corpus(5, 24)).selectExpr("*", "1 as _key", "2 as component_id", "3 as contaminated", "4 as _row")
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = step(spark, df, str(tmp_path))
        assert out.columns == df.columns and out.count() > 0
