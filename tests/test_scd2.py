"""SCD2 history: hand-written cases and a property test against a brute-force model.

The property test uses very few range partitions, so a key with many rows (a hot key)
is spread over several partitions and every cross-partition carry is exercised.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.operators.scd2 import END, START, as_of, current_rows, scd2_history

T0 = dt.datetime(2024, 1, 1)


def ts(day: int) -> dt.datetime:
    return T0 + dt.timedelta(days=day)


def brute_force(rows, tracked_idx, untracked_idx):
    """rows: (key, seq, tie, values...). Returns {(key, start): (tracked, untracked, end)}."""
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    out = {}
    for key, rs in by_key.items():
        last_per_seq = {}
        for r in sorted(rs, key=lambda r: (r[1], r[2])):
            last_per_seq[r[1]] = r  # the largest tie-breaker wins
        versions = []
        for seq in sorted(last_per_seq):
            r = last_per_seq[seq]
            tracked = tuple(r[3 + i] for i in tracked_idx)
            untracked = tuple(r[3 + i] for i in untracked_idx)
            if not versions or versions[-1][1] != tracked:
                versions.append([seq, tracked, untracked])
            else:
                versions[-1][2] = untracked
        for i, (start, tracked, untracked) in enumerate(versions):
            end = versions[i + 1][0] if i + 1 < len(versions) else None
            out[(key, start)] = (tracked, untracked, end)
    return out


def run(spark, rows, partitions):
    df = spark.createDataFrame(rows, "k string, seq timestamp, tie int, city string, uid string")
    hist = scd2_history(df, keys=["k"], sequence_by="seq", except_columns=["seq", "tie"],
                        track_history_except=["uid"], tie_breaker=["tie"],
                        num_partitions=partitions)
    return {(r.k, r[START]): ((r.city,), (r.uid,), r[END]) for r in hist.collect()}, hist


def test_hand_cases(spark):
    rows = [
        # identical repeat opens nothing
        ("rep", ts(0), 0, "A", "u"), ("rep", ts(1), 1, "A", "u"),
        # change, then back: A -> B -> A gives three versions
        ("aba", ts(0), 0, "A", "u"), ("aba", ts(1), 1, "B", "u"), ("aba", ts(2), 2, "A", "u"),
        # only the untracked column changes: one version, last value shown
        ("uid", ts(0), 0, "A", "u1"), ("uid", ts(1), 1, "A", "u2"),
        # NULL -> value is a change; NULL -> NULL is not
        ("nul", ts(0), 0, None, "u"), ("nul", ts(1), 1, None, "u"), ("nul", ts(2), 2, "C", "u"),
        # two rows with one sequence value: the larger tie-breaker wins
        ("tie", ts(0), 0, "A", "u"), ("tie", ts(1), 5, "Z", "u"), ("tie", ts(1), 3, "B", "u"),
        # out of order arrival: input order does not matter
        ("ooo", ts(2), 2, "C", "u"), ("ooo", ts(0), 0, "A", "u"), ("ooo", ts(1), 1, "B", "u"),
    ]
    got, hist = run(spark, rows, 3)
    assert got == brute_force(rows, [0], [1])
    assert got[("rep", ts(0))] == (("A",), ("u",), None)
    assert got[("uid", ts(0))] == (("A",), ("u2",), None)
    assert [v[2] for k, v in sorted(got.items()) if k[0] == "aba"] == [ts(1), ts(2), None]
    assert got[("tie", ts(1))][0] == ("Z",)
    assert current_rows(hist).count() == 6
    assert {r.k: r.city for r in as_of(hist, ts(1)).collect()}["aba"] == "B"


def test_default_tie_breaker_and_all_untracked(spark):
    df = spark.createDataFrame(
        [("k", ts(0), "A"), ("k", ts(0), "B"), ("k", ts(1), "C")], "k string, s timestamp, v string")
    hist = scd2_history(df, ["k"], "s", except_columns=["s"]).collect()
    assert [(r.v, r[START]) for r in sorted(hist, key=lambda r: r[START])] == [("B", ts(0)), ("C", ts(1))]
    untracked = scd2_history(df, ["k"], "s", except_columns=["s"], track_history_except=["v"]).collect()
    assert [(r.v, r[START], r[END]) for r in untracked] == [("C", ts(0), None)]


def test_hot_key_spans_many_partitions(spark):
    # one key holds most rows; with 8 partitions it is cut several times
    rows = [("hot", ts(i), i, "ABCD"[(i // 7) % 4], f"u{i}") for i in range(400)]
    rows += [(f"k{j}", ts(j), 0, "X", "u") for j in range(40)]
    got, _ = run(spark, rows, 8)
    assert got == brute_force(rows, [0], [1])


def test_without_checkpoint_same_result(spark):
    rows = [("a", ts(i), i, "AB"[i % 3 == 0], "u") for i in range(30)]
    df = spark.createDataFrame(rows, "k string, seq timestamp, tie int, city string, uid string")
    args = dict(keys=["k"], sequence_by="seq", except_columns=["seq", "tie"],
                track_history_except=["uid"], tie_breaker=["tie"], num_partitions=4)
    a = sorted(tuple(r) for r in scd2_history(df, **args).collect())
    b = sorted(tuple(r) for r in scd2_history(df, checkpoint=False, **args).collect())
    assert a == b


row = st.tuples(
    st.sampled_from(["a", "b", "c", "hot", "hot", "hot", "hot"]),
    st.integers(0, 30),
    st.integers(0, 1000),
    st.sampled_from(["X", "Y", None]),
    st.sampled_from(["u", "v", None]),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1], r[2])),
       st.integers(1, 6))
def test_matches_brute_force(spark, raw, partitions):
    rows = [(k, ts(s), tie, city, uid) for k, s, tie, city, uid in raw]
    got, hist = run(spark, rows, partitions)
    assert got == brute_force(rows, [0], [1])
    # intervals per key are contiguous and exactly one is open
    by_key = {}
    for (k, start), (_, _, end) in got.items():
        by_key.setdefault(k, []).append((start, end))
    for spans in by_key.values():
        spans.sort()
        assert sum(e is None for _, e in spans) == 1
        for (s1, e1), (s2, _) in zip(spans, spans[1:]):
            assert e1 == s2
