"""Data-quality operators: drop-on-failure expectations, per-rule counts, key checks.

All of them are single Spark plans; none pulls data to the driver. Counting is done
with global or keyed aggregates, which Spark pre-aggregates on the map side, so a hot
key never sends all of its rows to one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import Rule


def _holds(rule: Rule) -> Column:
    # A NULL outcome counts as a failure, exactly like a FALSE one.
    return F.coalesce(F.expr(rule.predicate), F.lit(False))


def all_rules_hold(rules: Iterable[Rule]) -> Column:
    out = F.lit(True)
    for rule in rules:
        out = out & _holds(rule)
    return out


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Keep a row only when every rule is TRUE for it (one filter for all rules)."""
    if not rules:
        return df
    return df.filter(all_rules_hold(rules))


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str | None = None):
    """Attach per-rule failure counters to ``df`` without an extra pass.

    Batch: returns ``(df, Observation)``; read ``observation.get`` after an action.
    Streaming: pass ``name``; the counters arrive in the query's progress under
    ``observedMetrics[name]``.
    """
    metrics = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(~_holds(r)).alias(r.name) for r in rules
    ]
    if name is not None:
        return df.observe(name, *metrics), None
    obs = Observation()
    return df.observe(obs, *metrics), obs


def rule_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(metric, n): ``rows`` and, under each rule's name, how many rows fail it; one aggregate."""
    names = ["rows", *[r.name for r in rules]]
    counts = df.agg(F.count(F.lit(1)).alias("_0"), *[
        F.count_if(~_holds(r)).alias(f"_{k}") for k, r in enumerate(rules, 1)])
    pairs = [F.struct(F.lit(n).alias("metric"), F.col(f"_{k}").cast("long").alias("n")) for k, n in enumerate(names)]
    return counts.select(F.inline(F.array(*pairs)))


def rule_counts(df: DataFrame, rules: Sequence[Rule], dataset: str) -> DataFrame:
    """One row per rule: (dataset, rule, passed, failed) in one aggregate pass."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.count_if(_holds(r)).alias(f"__p{i}") for i, r in enumerate(rules)]
    summary = df.agg(*aggs)
    stacked = F.explode(
        F.array(*[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.col(f"__p{i}").alias("passed"),
                (F.col("__rows") - F.col(f"__p{i}")).alias("failed"),
            )
            for i, r in enumerate(rules)
        ])
    ).alias("r")
    return summary.select(stacked).select(
        F.lit(dataset).alias("dataset"),
        F.col("r.rule").alias("rule"),
        F.col("r.passed").cast("long").alias("passed"),
        F.col("r.failed").cast("long").alias("failed"),
    )


#: Key values that one task counts, and the shares that the rows of a hot key are dealt over before.
KEYS_PER_TASK, KEY_SHARES = 500_000, 16


def key_violations(df: DataFrame, keys: Sequence[str], rows: int = 0) -> DataFrame:
    """Primary-key check: every key value seen more than once or containing a NULL.

    Output: the key columns and ``n_rows``. Empty when the key is a valid primary key. ``rows`` is about the
    number of rows, if known: with more than the shuffle partitions hold at ``KEYS_PER_TASK`` each, the keys are
    dealt over as many tasks as they need, first in shares, so that a hot key is not one task's.
    """
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    tasks = math.ceil(rows / KEYS_PER_TASK)
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        share = F.pmod(F.spark_partition_id(), F.lit(KEY_SHARES))
        parts = df.select(*keys, share.alias("__share")).repartition(tasks, *keys, "__share")
        parts = parts.groupBy(*keys, "__share").agg(F.count(F.lit(1)).alias("__n"))
        counted = parts.repartition(tasks, *keys).groupBy(*keys).agg(F.sum("__n").alias("n_rows"))
    else:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter((F.col("n_rows") > 1) | any_null)


def orphans(
    child: DataFrame,
    parent: DataFrame,
    foreign_key: Sequence[str],
    parent_key: Sequence[str] | None = None,
) -> DataFrame:
    """Foreign-key check: child key values with no parent row, with their row count.

    The child is reduced to one row per key value before the anti join, so both join
    sides are unique on the key and a hot key cannot skew the join. NULL foreign keys
    are not orphans (SQL semantics).
    """
    parent_key = list(parent_key or foreign_key)
    fk = list(foreign_key)
    not_null = F.lit(True)
    for k in fk:
        not_null = not_null & F.col(k).isNotNull()
    counted = child.filter(not_null).groupBy(*fk).agg(F.count(F.lit(1)).alias("n_rows"))
    parents = parent.select(
        *[F.col(p).alias(c) for p, c in zip(parent_key, fk)]
    ).distinct()
    return counted.join(parents, on=fk, how="left_anti")


def schema_mismatches(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str]]:
    """Compare a dataset's schema with the declared one (metadata only, no data read).

    Returns ``(column, expected_type, actual_type)`` for missing, extra or mistyped
    columns; an empty list means the schema conforms.
    """
    have = {f.name: f.dataType.simpleString() for f in actual.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    out = []
    for name, dtype in want.items():
        if have.get(name) != dtype:
            out.append((name, dtype, have.get(name, "<missing>")))
    for name, dtype in have.items():
        if name not in want:
            out.append((name, "<absent>", dtype))
    return out
