"""Key checks kept by summaries, and the change feed of a table of key buckets."""

import pytest
from pyspark.sql import functions as F

from strata.operators.changes import snapshot_changes
from strata.operators.quality import key_violations, orphans
from strata.sources.buckets import BucketTable
from strata.streaming.key_checks import ForeignKey, KeySummary


def _sorted(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_summaries_equal_the_checks_of_whole_tables(spark, scratch):
    root = scratch("keys")
    frame = lambda rows: spark.createDataFrame([(r, "x") for r in rows], "k string, other string")
    children = [[f"k{n % 40}" for n in range(90)] + [None, None], ["k7", "k50", "k51", None], ["k60"], []]
    parents = [[f"k{n}" for n in range(30)], ["k7", "k50"], [], [f"k{n}" for n in range(30, 40)]]
    child, parent = (KeySummary(spark, f"{root}/{s}", ["k"], 16) for s in ("child", "parent"))
    relation = ForeignKey(spark, f"{root}/orphans", child, parent)
    seen = [[], []]
    for n, (c, p) in enumerate(zip(children, parents)):
        seen[0] += c
        seen[1] += p
        before = child.table.files()
        hit = child.add(frame(c), f"d{n}")
        if n == 1:
            after = child.table.files()
            assert {b for b in after if after[b] != before.get(b)} == set(hit) and len(hit) < 16
            child.add(frame(c), f"d{n}")  # a replay counts nothing twice
        relation.refresh(sorted({*hit, *parent.add(frame(p), f"d{n}")}), f"d{n}")
        for summary, rows in zip((child, parent), seen):
            assert _sorted(summary.violations()) == _sorted(key_violations(frame(rows), ["k"]))
        assert _sorted(relation.orphans()) == _sorted(orphans(frame(seen[0]), frame(seen[1]), ["k"]))
    assert {r.k for r in relation.orphans().collect()} == {"k51", "k60"}


def test_summaries_must_have_the_same_buckets(spark, scratch):
    a, b = KeySummary(spark, scratch("a"), ["k"], 4), KeySummary(spark, scratch("b"), ["k"], 8)
    with pytest.raises(ValueError):
        ForeignKey(spark, scratch("c"), a, b)


def test_the_feed_has_the_changes_of_hit_buckets(spark, scratch, monkeypatch):
    root = scratch("feed")
    old = spark.range(200).select(F.concat(F.lit("k"), "id").alias("k"), F.lit("a").alias("v"))
    plain = BucketTable(spark, f"{root}/t", ["k"], 32)
    plain.replace(old, list(range(32)), "one")
    table = BucketTable(spark, f"{root}/t", ["k"], 32, feed=f"{root}/feed")
    changed = spark.createDataFrame([("k1", "b"), ("k2", "a"), ("new", "n")], "k string, v string")
    gone = ["k3"]
    hit = table.hit(changed.select("k").union(spark.createDataFrame([(g,) for g in gone], "k string")))
    names = [r.k for r in changed.collect()] + gone
    after = table.read(hit).filter(~F.col("k").isin(names)).unionByName(changed)
    read = []
    real = BucketTable.read
    monkeypatch.setattr(BucketTable, "read", lambda self, hit=None: read.append(hit) or real(self, hit))
    table.replace(after, hit, "two")
    assert read == [hit]  # no other bucket is compared
    table.replace(None, hit, "two")  # a replay leaves the feed as it is
    got = table.changes()
    assert {r.change for r in got.collect()} == {"two"}
    assert _sorted(got.drop("change")) == _sorted(snapshot_changes(old, real(table), ["k"]))
    assert sorted((r._change_type, r.k, r.v) for r in got.collect()) == [
        ("delete", "k3", "a"), ("insert", "new", "n"), ("update_postimage", "k1", "b"), ("update_preimage", "k1", "a")]
