"""Join helpers: broadcast behind a measured size check, and a salted join for hot keys.

Batch joins otherwise stay plain equi-joins: with AQE on, Spark converts a join to a
broadcast only after measuring the finished shuffle stage (a proven size), and splits
skewed shuffle partitions of sort-merge joins by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir

# Default bounds for an explicit broadcast: rows and measured bytes.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def _cell_bytes(name: str, dtype: T.DataType) -> Column:
    """Bytes that a value takes: its text or binary length, 16 for any fixed-width value, and the
    length of the JSON text for nested values."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + 16
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0)) + 16
    return F.lit(16)


def broadcast_fits(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and at most ``max_bytes`` bytes: one aggregate, two
    numbers per task."""
    if df.isStreaming:
        return False
    width = F.lit(0).cast("long")
    for f in df.schema.fields:
        width = width + _cell_bytes(f.name, f.dataType)
    seen = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes")).first()
    return seen["n"] <= max_rows and (seen["bytes"] or 0) <= max_bytes


def sized_broadcast(
    df: DataFrame,
    max_rows: int = BROADCAST_MAX_ROWS,
    max_bytes: int = BROADCAST_MAX_BYTES,
    stored: bool = False,
) -> DataFrame:
    """``broadcast(df)`` if it passes the measured size check, else ``df`` without the hint (the join then
    shuffles, and AQE may still broadcast it after measuring).

    The rows are measured and used, so they are computed once and written to the shared scratch folder, and
    both read them there; ``stored`` says that ``df`` is read from storage as it is."""
    if df.isStreaming:
        return df
    if not stored:
        path = f"{scratch_dir(df.sparkSession, 'join-side')}/rows"
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    return F.broadcast(df) if broadcast_fits(df, max_rows, max_bytes) else df


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int) -> DataFrame:
    """Every key holding at least ``min_rows`` rows, with its row count ``__n``: at most
    1 / ``min_rows`` of the rows, whatever the data."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") >= min_rows)
    )


def salt_table(df: DataFrame, keys: Sequence[str], min_rows: int = 1_000_000) -> DataFrame:
    """The hot keys of ``df`` and ``__salts``, their number of shares: one per ``min_rows`` rows."""
    keys = list(keys)
    not_null = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return hot_keys(df.filter(not_null), keys, min_rows).select(
        *keys, F.ceil(F.col("__n") / min_rows).cast("int").alias("__salts"))


def join_by_salts(big: DataFrame, other: DataFrame, keys: Sequence[str], salts: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join in which the rows of ``big`` with a hot key are dealt over the key's shares and the matching
    rows of ``other`` are copied once per share. ``salts`` is a static ``salt_table``.

    Rows of ``big`` get their share from a hash of the whole row (deterministic, so a recomputed task produces
    the same split). NULL keys match nothing; in a left join they are spread by the same hash. The result
    equals the plain join for ``how`` in {inner, left} with ``big`` on the left.

    On streams the shares are part of what join state is kept under: take the salts from an earlier snapshot
    and keep them as long as the checkpoint. A key that becomes hot later is not split until then, but joined
    rightly."""
    if how not in ("inner", "left"):
        raise ValueError("a salted join is an inner or a left join")
    keys = list(keys)
    not_null = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    big_salted = big.join(salts, on=keys, how="left").withColumn(
        "__salt",
        F.when(~not_null, row_hash)
        .when(F.col("__salts").isNotNull(), F.pmod(row_hash, F.col("__salts")))
        .otherwise(F.lit(0)),
    ).drop("__salts")
    other_salted = other.join(salts, on=keys, how="left").withColumn(
        "__salt",
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col("__salts"), F.lit(1)) - 1)),
    ).withColumn("__salt", F.col("__salt").cast("long")).drop("__salts")
    return big_salted.join(other_salted, on=keys + ["__salt"], how=how).drop("__salt")


def salted_join(
    big: DataFrame,
    other: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    min_rows: int = 1_000_000,
) -> DataFrame:
    """Equi-join that spreads each hot key of ``big`` over one task per ``min_rows`` rows: the hot keys are
    counted once and stored, then ``join_by_salts``."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    return join_by_salts(big, other, keys, sized_broadcast(salt_table(big, keys, min_rows)), how)
