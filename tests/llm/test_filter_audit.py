"""The audit against filters that are really applied one after another."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from strata.llm.filter_audit import NAMES, failed_filters, interaction_audit
from tests.llm.helpers import corpus, docs

LONG = " ".join(f"word{k}" for k in range(230))
ODD = [
    (800, LONG), (801, LONG), (802, LONG.upper()), (803, LONG + " #"), (804, "same " * 300), (805, "SAME " * 300 + "|"),
    (806, LONG), (806, LONG), (807, "A"), (808, "é" * 49 + "A"), (809, "é" * 50 + "A"), (810, " ".join("ab" * 100)),
    (None, LONG), (None, LONG), (811, " ".join(["x", "y"] * 100)), (812, " ".join(f"x{k}" for k in range(199))),
]
ROWS = corpus() + ODD
LABELS = [(800, 1, 0), (801, 1, 1), (801, 0, 0), (802, 0, 1), (804, 1, None), (805, None, 1), (806, 1, 1), (9999, 1, 1),
          (None, 1, 1)] + [(i, i % 2, i % 3) for i in range(0, 60, 2)]


def _fails(rows):
    out = []
    for i, t in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)),
             "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u in rows)}
        out.append({x for x in f if f[x]})
    return out


def _applied(rows, sources, labels, names=NAMES):
    fails = _fails(rows)
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    out = {}
    for part in set(sources):
        own = [k for k in range(len(rows)) if sources[k] == part]
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            left = own
            for step, f in enumerate(order, 1):
                gone = [k for k in left if f in fails[k]]
                left = [k for k in left if f not in fails[k]]
                shapley[f] += len(gone)
                failing = [k for k in own if f in fails[k]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone), sum(fails[k] == {f} for k in own),
                    sum(rows[k][0] in good for k in gone), sum(rows[k][0] in toxic for k in gone), f]
        for key in out:
            if key[0] == part:
                out[key][6] = shapley[out[key][6]]
    return sorted((*key, *value) for key, value in out.items())


def test_rows_equal_filters_applied_in_turn(spark):
    df = docs(spark, ROWS).selectExpr("*", "7 as mask", "8 as part", "9 as n", "10 as sha").drop("mask")
    df = df.selectExpr("doc_id", "text", "nullif(source, 'src2') as source", "part", "n", "sha", "true as first", "1 as good")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "5 as part", "6 as n")
    sources = ["" if (i or 0) % 3 == 2 else f"src{(i or 0) % 3}" for i, _ in ROWS]
    got = sorted(tuple(r) for r in interaction_audit(failed_filters(df, labels)).collect())
    want = _applied(ROWS, sources, LABELS)
    assert got == want
    assert len(got) == 3 * 120 * 5 and all(any(r[c] for r in got) for c in range(3, 10))


@pytest.mark.parametrize("names", ["X", "XY", "PQRS"])
def test_any_number_of_filters(spark, names):
    rows = [("p", m, m * m % 7 + 1, m % 3, m % 2) for m in range(2 ** len(names))]
    got = interaction_audit(spark.createDataFrame(rows, "part string, mask int, n long, good long, toxic long"), names).collect()
    total = sum(r[2] for r in rows)
    value = lambda s: sum(r[2] for r in rows if r[1] & s)
    shapley = dict.fromkeys(names, 0)
    for order in permutations(names):
        seen = 0
        for f in order:
            shapley[f] += value(seen | 1 << names.index(f)) - value(seen)
            seen |= 1 << names.index(f)
    assert len(got) == len(list(permutations(names))) * len(names)
    for r in got:
        assert r.shapley == shapley[r.filter_order[r.step - 1]]
        assert r.kept == total - value(sum(1 << names.index(f) for f in r.filter_order[:r.step]))


def test_names_must_differ(spark):
    with pytest.raises(ValueError):
        interaction_audit(spark.createDataFrame([], "part string, mask int, n long, good long, toxic long"), "AAB")


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interaction_audit(failed_filters(docs(spark, []), none)).collect() == []
    got = interaction_audit(failed_filters(docs(spark, [(1, None)]), none)).collect()
    assert len(got) == 600 and {r.removed for r in got if r.filter_order[r.step - 1] == "A"} == {1}
    assert not any(r.good_lost or r.toxic_lost for r in got)
