"""Rows that share a doc_id but hold different texts."""

from strata.llm.stages import drop_contaminated, drop_near_dups

from .helpers import docs


def test_a_clean_row_outlives_a_contaminated_one_of_its_id(spark):
    item = " ".join(f"b{k}" for k in range(20))
    clean = " ".join(f"c{k}" for k in range(40))
    rows = [(1, item), (1, clean), (2, item), (3, clean), (3, clean), (None, item), (None, clean), (4, None)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = sorted((r.doc_id or 0, r.text or "") for r in drop_contaminated(docs(spark, rows), items).collect())
    assert got == sorted([(1, clean), (3, clean), (3, clean), (0, clean), (4, "")])


def test_near_dedup_loses_no_text_of_a_repeated_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (7, a), (7, b), (9, c), (9, c), (None, b), (None, a + " z")]
    want = [(1, a), (7, b), (9, c)]
    for given in (rows, rows[::-1]):
        got = [(r.doc_id, r.text) for r in drop_near_dups(docs(spark, given, extra=False), 4, 4).collect()]
        assert sorted(g for g in got if g[0] is not None) == want and (None, b) not in got


def test_near_dedup_keeps_the_same_row_in_any_order(spark):
    words = [f"w{k}" for k in range(200)]
    near = [" ".join(words[:k] + ["x"] + words[k + 1:]) for k in (20, 90, 150)]
    rows = [(5, t) for t in near] + [(None, t) for t in near] + [(6, near[0])]
    one = {tuple(r) for given in (rows, rows[::-1], rows[3:] + rows[:3])
           for r in drop_near_dups(docs(spark, given), 4, 8).select("doc_id", "text").collect()}
    assert len(one) == 1 and one.pop()[0] == 5


def test_null_ids_and_texts_have_one_group(spark):
    rows = [(None, None), (None, ""), (None, " \n"), (None, "some text that stands alone here")]
    got = [r.text for r in drop_near_dups(docs(spark, rows)).collect()]
    assert len(got) == 2 and "some text that stands alone here" in got
