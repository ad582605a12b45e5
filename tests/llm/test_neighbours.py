"""Nearest neighbours against brute force: recall, exact lists where the beam covers a shard, odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import hnsw
from strata.llm.neighbours import build_index, nearest_neighbours, search, usable

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows, k, is_query=lambda i: i % 20 == 0):
    """{(query id, vector): [(id, product), ...]} over distinct (id, vector) rows."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    out = {}
    for i, v in ok:
        if is_query(i):
            near = [(-float(np.dot(np.float64(v), np.float64(w))), j) for j, w in ok if j != i and len(w) == len(v)]
            out[i, v] = [(j, -s) for s, j in sorted(near)[:k]]
    return out


def _lists(result):
    out = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def _floats(rng, n, dim):
    return rng.normal(size=(n, dim)).astype(np.float32)


def _recall(want, got):
    hits = [len({j for j, _ in want[q]} & {j for j, _ in got.get(q[0], [])}) / len(want[q]) for q in want if want[q]]
    return float(np.mean(hits))


@pytest.mark.parametrize("lengths", [False, True])
def test_recall_over_several_shards(spark, lengths):
    rng = np.random.default_rng(3)
    x = _floats(rng, 3000, 48)
    if lengths:  # products then favour long vectors
        x *= rng.lognormal(0, 0.7, size=(3000, 1)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = _lists(nearest_neighbours(df, F.col("vec_id") % 20 == 0, 20, shard_rows=700, block_rows=40, task_blocks=2))
    want = _brute(rows, 20)
    assert set(got) == {i for i, _ in want} and all(len(v) == 20 for v in got.values())
    assert _recall(want, got) >= 0.95
    for i, near in got.items():
        for j, score in near:
            assert j != i and score == pytest.approx(float(x[i].astype(np.float64) @ x[j].astype(np.float64)), abs=1e-12)


def test_clusters_of_near_copies_are_found(spark):
    """A third of the vectors lie within a hair of one point, the others far from it."""
    rng = np.random.default_rng(5)
    x = _floats(rng, 1500, 32)
    x[::3] = x[0] + 1e-3 * _floats(rng, 500, 32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = _lists(nearest_neighbours(df, F.col("vec_id") % 20 == 0, 20, shard_rows=800))
    assert _recall(_brute(rows, 20), got) >= 0.9


def _odd_rows():
    rng = np.random.default_rng(9)
    x = [[float(c) for c in v] for v in _floats(rng, 160, 6)]
    rows = [(i, v) for i, v in enumerate(x)]
    common = [1.0, 0.5, 0.0, -1.0, 2.0, 0.25]
    rows += [(200 + i, common) for i in range(90)]  # many copies of one vector, queries among them
    rows += [(200, common)] * 50  # a repeated row
    rows += [(290, [-0.0 if c == 0 else c for c in common])]
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (380, [float("nan")] * 6),
             (400, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0]), (None, common), (420, [-0.0] * 6)]
    rows += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (502, [-1.0, 0.5])]  # another length: a space of its own
    rows += [(600, [9.0, 1.0, 1.0])]  # no candidate: no rows
    rows += [(700, [5.0, 5.0, 5.0, 5.0, 5.0, 5.0]), (701, [5.0, 5.0, 5.0, 5.0, 5.0, 5.0])]
    rows += [(721, x[3]), (721, x[4])]  # one id, two vectors: two candidates
    return rows


def test_odd_rows_give_the_exact_lists(spark):
    rows = _odd_rows()
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).selectExpr(
        "*", "1 as shard", "2 as rank", "'x' as score", "3 as dim", "4 as query_id")
    got = _lists(nearest_neighbours(df, F.col("vec_id") % 20 == 0, 20, shard_rows=60, block_rows=5))
    want = {i: near for (i, _), near in _brute(rows, 20).items() if near}
    assert set(got) == set(want)
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]], i
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]], abs=1e-12)


def test_an_id_with_two_vectors_asks_twice(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [0.1, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    got = nearest_neighbours(df, F.col("vec_id") % 20 == 0, 1).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(20, 1, 1), (20, 1, 2)]


def test_doubles_keep_their_precision(spark):
    rows = [(i, [1.0, 1e-12 * i]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = _lists(nearest_neighbours(df, F.col("vec_id") == 39, 3))
    assert [j for j, _ in got[39]] == [j for j, _ in _brute(rows, 3, lambda i: i == 39)[39, (1.0, 39e-12)]]


def test_empty_table_and_no_query(spark):
    assert nearest_neighbours(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    df = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], SCHEMA)
    assert nearest_neighbours(df, F.col("vec_id") % 20 == 0).collect() == []


def test_the_index_is_one_row_of_flat_arrays_per_shard(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(_floats(rng, 500, 8))], SCHEMA)
    index = build_index(df, 5, shard_rows=100)
    rows = index.collect()
    assert len(rows) == 5 and sum(r.sizes[0] for r in rows) == 500
    assert all(len(r.links) == 4 * sum(n * w for n, w in zip(r.sizes, r.widths)) for r in rows)
    again = _lists(search(index, df, F.col("vec_id") < 10, 5))
    assert set(again) == set(range(10))


def test_usable(spark):
    rows = [([1.0],), ([0.0],), ([],), (None,), ([None, 1.0],), ([float("nan")],), ([float("-inf")],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r[0] for r in df.select(usable(F.col("v"))).collect()] == [True] + [False] * 6


def test_every_node_can_be_reached():
    x = np.random.default_rng(1).normal(size=(1200, 40)).astype(np.float32)
    _, graph = hnsw.build(x, degree=8, width=48)
    links = graph.links[0]
    seen, ahead = {0}, [0]
    while ahead:
        ahead = [j for j in {int(j) for i in ahead for j in links[i] if j >= 0} if j not in seen]
        seen.update(ahead)
    assert len(seen) == 1200
    for row in links:
        near = row[row >= 0]
        assert len(set(near.tolist())) == len(near)
