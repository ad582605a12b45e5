"""Slowly changing dimension, type 2, computed from an append-only change log.

Semantics (per key, in sequence order):

* rows sharing a (key, sequence) are reduced to one: the largest tie-breaker wins;
* a version opens at the key's first row and whenever a tracked column differs,
  NULL-safely, from the previous row; identical repeats open nothing;
* untracked columns (``track_history_except``) never open a version and show their
  last value inside the version;
* ``__START_AT`` is the version's first sequence value, ``__END_AT`` the next
  version's start (NULL for the open version).

Plan, built so that no key, however hot, is ever held by a single task:

1. Dedupe on (key, sequence) with an aggregate. Spark combines on the map side, so even
   a group of copies holding a third of the log shrinks before the shuffle. (The payload is
   a struct with text, so both sides of the aggregate sort.)
2. Range-partition the deduplicated rows on (key, sequence) into P partitions. A hot
   key spans many partitions; every (key, partition) group has at most about N / P
   rows.
3. Per (key, partition) group, window functions give each row its predecessor, its
   running version start and the next change after it.
4. Only the first and last key of each partition can continue across a partition
   boundary. Their carries come from a table with one row per partition: at most P
   rows, a proven bound, broadcast back to the rows.
5. A keyed aggregate per (key, version) yields the history. It combines on the map
   side too, so a long version spread over many partitions stays cheap.

The ranged rows feed a per-partition summary and the windows. They are written once to the
shared folder named in ``spark.checkpoint.dir`` (which fixes the partition ids and cuts the
lineage: a lost executor costs a re-read) without the key and tracked columns a second time.
The window over (key, partition) is needed by the summary of the changes and by the version
spans; each shuffles only the columns it needs (the summary: keys and tracked columns). The
exchanges of data are the dedupe, the range, these two and the version aggregate. No session
setting is changed on the way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import scratch_dir

START, END, LAST = "__START_AT", "__END_AT", "__LAST_AT"


def _struct_or_const(df_col: str, names: Sequence[str]) -> Column:
    if not names:
        return F.lit(0)
    return F.struct(*[F.col(df_col)[n].alias(n) for n in names])


def _materialize(df: DataFrame, checkpoint: bool) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back."""
    if not checkpoint:
        return df
    path = f"{scratch_dir(df.sparkSession, 'scd2')}/ranged"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scd2_history(
    log: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    except_columns: Sequence[str] = (),
    track_history_except: Sequence[str] = (),
    tie_breaker: Sequence[str] | None = None,
    num_partitions: int | None = None,
    checkpoint: bool = True,
    last_at: bool = False,
) -> DataFrame:
    """History table of ``log``: target columns plus ``__START_AT`` / ``__END_AT``.

    ``except_columns`` are left out of the target (the sequence column may be one of
    them). ``tie_breaker`` orders rows that share a (key, sequence); by default all
    target columns other than the keys, in order. Rows with a NULL sequence cannot be
    placed in time and are not part of the history; ``unplaced`` counts them. ``num_partitions`` (P) defaults to
    ``spark.sql.shuffle.partitions``. ``checkpoint=False`` keeps the plan lazy (the ranged
    rows are then recomputed by each consumer). ``last_at`` adds ``__LAST_AT``, the last sequence
    seen inside the version.
    """
    keys = list(keys)
    target = [c for c in log.columns if c not in set(except_columns)]
    missing = [k for k in keys if k not in target]
    if missing:
        raise ValueError(f"keys {missing} are not target columns")
    payload = [c for c in target if c not in keys]
    untracked = [c for c in payload if c in set(track_history_except)]
    tracked = [c for c in payload if c not in set(track_history_except)]
    tie = list(tie_breaker) if tie_breaker is not None else payload
    if num_partitions is None:
        num_partitions = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # 1. one row per (key, sequence), map-side combined
    rows = log.filter(F.col(sequence_by).isNotNull()).select(
        *keys,
        F.col(sequence_by).alias("__seq"),
        F.struct(*[F.col(c) for c in payload] or [F.lit(0).alias("__none")]).alias("__row"),
        F.struct(*[F.col(c) for c in tie] or [F.lit(0).alias("__none")]).alias("__tie"),
    )
    dedup = rows.groupBy(*keys, "__seq").agg(F.max_by("__row", "__tie").alias("__row"))

    # 2. contiguous, balanced ranges of (key, sequence)
    ranged = _materialize(
        dedup.repartitionByRange(num_partitions, *keys, "__seq")
        .withColumn("__pid", F.spark_partition_id()),
        checkpoint,
    ).withColumns({"__k": F.struct(*keys), "__t": _struct_or_const("__row", tracked)})

    # 4a. per partition: its first key and its last row -> predecessor carry
    bounds = ranged.groupBy("__pid").agg(
        F.min("__k").alias("__fk"),
        F.max_by(F.struct("__k", "__t"), F.struct("__k", "__seq")).alias("__last"),
    )
    in_order = Window.partitionBy(F.lit(0)).orderBy("__pid")
    prev_last = F.lag("__last").over(in_order)
    carry_prev = bounds.select(
        "__pid",
        F.when(prev_last["__k"].eqNullSafe(F.col("__fk")), prev_last["__t"]).alias("__carry_t"),
        F.col("__fk").alias("__carry_k"),
    ).filter(F.col("__carry_t").isNotNull())

    # 3a. predecessor inside the group, else the carry; change flag
    group = Window.partitionBy(*keys, "__pid").orderBy("__seq")
    flagged = (
        ranged.withColumn("__prev", F.lag("__t").over(group))
        .join(F.broadcast(carry_prev), on="__pid", how="left")
        .withColumn(
            "__prev",
            F.coalesce(
                F.col("__prev"),
                F.when(F.col("__k").eqNullSafe(F.col("__carry_k")), F.col("__carry_t")),
            ),
        )
        .withColumn(
            "__cs",
            F.when(~F.col("__prev").eqNullSafe(F.col("__t")), F.col("__seq")),
        )
        .drop("__carry_t", "__carry_k", "__prev")
    )

    # 4b. per partition: first change of its first key, last change of its last key
    edges = flagged.groupBy("__pid").agg(
        F.min(F.struct(
            F.col("__k").alias("k"),
            F.col("__cs").isNull().alias("none"),
            F.col("__cs").alias("cs"),
        )).alias("__first"),
        F.max(F.struct(
            F.col("__k").alias("k"),
            F.col("__cs").isNotNull().alias("some"),
            F.col("__cs").alias("cs"),
        )).alias("__lastc"),
    ).select(
        "__pid",
        F.col("__first.k").alias("fk"), F.col("__first.cs").alias("fk_cs"),
        F.col("__lastc.k").alias("lk"), F.col("__lastc.cs").alias("lk_cs"),
    )
    run_back = Window.partitionBy("lk").orderBy("__pid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    run_fwd = Window.partitionBy("fk").orderBy(F.col("__pid").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edges = edges.withColumn("cum_last", F.max("lk_cs").over(run_back)).withColumn(
        "cum_first", F.min("fk_cs").over(run_fwd))
    carry_runs = edges.select(
        "__pid",
        F.col("fk").alias("__cfk"),
        F.col("lk").alias("__clk"),
        F.when(F.lag("lk").over(in_order).eqNullSafe(F.col("fk")),
               F.lag("cum_last").over(in_order)).alias("__carry_start"),
        F.when(F.lead("fk").over(in_order).eqNullSafe(F.col("lk")),
               F.lead("cum_first").over(in_order)).alias("__carry_next"),
    )

    # 3b. running version start and next change, inside the group, else the carries
    upto = group.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = group.rowsBetween(1, Window.unboundedFollowing)
    spans = (
        flagged.withColumn("__vs", F.max("__cs").over(upto))
        .withColumn("__ve", F.min("__cs").over(after))
        .join(F.broadcast(carry_runs), on="__pid", how="left")
        .select(
            *keys, "__seq", "__row", "__t",
            F.coalesce(
                F.col("__vs"),
                F.when(F.col("__k").eqNullSafe(F.col("__cfk")), F.col("__carry_start")),
            ).alias("__vstart"),
            F.coalesce(
                F.col("__ve"),
                F.when(F.col("__k").eqNullSafe(F.col("__clk")), F.col("__carry_next")),
            ).alias("__vend"),
        )
    )

    # 5. one row per version
    aggs = [F.max("__vend").alias(END), F.max("__seq").alias(LAST)]
    if tracked:
        aggs.append(F.min_by("__t", "__seq").alias("__tv"))
    if untracked:
        aggs.append(F.max_by(_struct_or_const("__row", untracked), "__seq").alias("__uv"))
    versions = spans.groupBy(*keys, "__vstart").agg(*aggs)
    out_cols = []
    for c in target:
        if c in keys:
            out_cols.append(F.col(c))
        elif c in tracked:
            out_cols.append(F.col("__tv")[c].alias(c))
        else:
            out_cols.append(F.col("__uv")[c].alias(c))
    return versions.select(*out_cols, F.col("__vstart").alias(START), END, *[LAST] * last_at)


def unplaced(log: DataFrame, sequence_by: str) -> DataFrame:
    """One row with ``n_rows``: how many change rows have a NULL sequence."""
    return log.filter(F.col(sequence_by).isNull()).agg(F.count(F.lit(1)).alias("n_rows"))


def current_rows(history: DataFrame) -> DataFrame:
    """The open version of every key."""
    return history.filter(f"{END} IS NULL")


def as_of(history: DataFrame, ts) -> DataFrame:
    """Versions valid at ``ts`` (start <= ts < end)."""
    t = F.lit(ts) if not isinstance(ts, Column) else ts
    return history.filter((F.col(START) <= t) & (F.col(END).isNull() | (F.col(END) > t)))
