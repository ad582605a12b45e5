"""Fill-in-the-middle rows against a plain Python version."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from strata.llm.fill_middle import digest, fill_middle, parts, restore
from tests.llm.helpers import corpus, docs

ODD = [
    (900, "one line"), (901, "\n"), (902, "\n\n\n"), (903, "a\r\nb\r\n"), (904, "é😀\n😀é\n日本"), (905, "x <P> y\nz"),
    (906, "<M>"), (907, "<S"), (908, "$1 \\2 \\\\n\n$2 {3}"), (909, "< P>\n<\nP>"), (910, "\n".join("ab" * k for k in range(300))),
    (911, "line\n" * 200_000), (912, "z" * 3_000_000), (913, "tail<\n>S>"), (914, " \u0085\x0b\x0c"), (900, "one line"),
    (900, "other text\nof a known id"), (915, "\x00\n\x00"),
]
ROWS = corpus() + ODD


def _brute(doc_id, text, seed=7, rate=100, spm_share=50):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    n = len(units)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or re.search("<[PSM]>", t) or h[2] % 100 >= rate:
        return n, "plain", None, t
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < spm_share:
        return n, "spm", (pre, mid, suf), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", (pre, mid, suf), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("seed,rate,spm_share", [(7, 100, 50), (1, 60, 30), (2, 0, 50), (3, 100, 0)])
def test_rows_equal_a_plain_version(spark, seed, rate, spm_share):
    out = fill_middle(docs(spark, ROWS), seed, rate, spm_share).withColumn("p", parts(F.col("output"), F.col("form")))
    got = [(r.doc_id, r.n, r.form, r.p and tuple(r.p), r.output) for r in out.collect()]
    want = [(i, *_brute(i, t, seed, rate, spm_share)) for i, t in ROWS]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_digest_has_lengths_and_the_restored_text(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for i, t in ROWS:
        n, form, p, out = _brute(i, t)
        want.append((i, n, form, p and len(p[0]), p and len(p[1]), sha(out), sha(t or "")))
    got = [tuple(r) for r in digest(fill_middle(docs(spark, ROWS))).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_restore_needs_output_and_form_only(spark):
    rows = fill_middle(docs(spark, ROWS)).select("output", "form")
    back = [r[0] for r in rows.select(restore(F.col("output"), F.col("form"))).collect()]
    assert sorted(back) == sorted(t or "" for _, t in ROWS)


def test_no_shuffle_and_no_python(spark):
    plan = digest(fill_middle(docs(spark, ROWS)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert digest(fill_middle(docs(spark, []))).collect() == []
