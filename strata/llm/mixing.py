"""Mixing sources to target weights, with DataFrame functions only.

Shares p of the sources (by tokens) are raised to an exponent a in [0, 1] and normalised:
q = p^a / sum(p^a). Flatter mixes (small a) have more entropy and repeat small sources more.
The exponent is bisected to the largest one that reaches the target entropy, then raised, if
need be, to the smallest one that keeps every source within the repetition limit (with a limit
alone, that one is taken). A source gets
``epochs = q * budget / tokens`` passes. Without a budget, it is the smallest that uses every
document at least once; so mixing then only repeats.

Each pass is a permutation of blocks: rows fall into blocks of about ``block_rows`` by a hash,
blocks are ordered by a hash of pass and block, rows in a block by a hash of pass and row. A
partial pass takes blocks in that order up to its token budget, and rows of the block on the
boundary up to the rest. So a pass is described by one boundary (block key, row key) per source,
and choosing rows is a comparison: no document is shuffled or ranked among all others, and a hot
source is as many blocks as it needs.

Defined cases: a null source is a source of its own; null and empty texts count 0 tokens; a source
without tokens is passed once; equal rows (same id and text) have equal keys and stay together; a
partial pass takes whole rows, so it exceeds its budget by less than one row (group of equal
rows); an empty table gives no rows; other columns are ignored by ``mix`` and kept by ``apply_mix``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.operators.joins import sized_broadcast

from .common import stage

#: Parts into which one job cuts the interval of the exponent, and the number of such jobs.
PARTS, ROUNDS = 32, 4


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_tokens, row_hash. The source key is never null: ``n`` or ``s`` and name."""
    return docs.select(
        F.col("doc_id"), F.col("source"), _source_key().alias("_s"), _row_hash().alias("_h"),
        word_count("text").alias("n_tokens"))


def _source_key() -> Column:
    return F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def _row_hash() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def _block(n_blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), F.col("_h")), n_blocks)


def _block_key(seed: int, epoch: Column, n_blocks: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.col("_s"), _block(n_blocks))


def _row_key(seed: int, epoch: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.lit("row"), F.col("_h"))


def _measure(sources: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """(exponent, entropy, largest number of passes) for each exponent, in one job."""
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    p = sources.filter("tokens > 0").select(F.log(F.col("tokens") / F.lit(float(total))).alias("lp"))
    grid = p.withColumn("a", F.explode(F.array(*[F.lit(float(a)) for a in exponents])))
    # With w = p^a and z = sum(w): entropy = log z - a * sum(w * log p) / z; passes of a source
    # are w / p / z * budget / total; without a budget the smallest number of passes is one.
    w = F.exp(F.col("a") * F.col("lp"))
    ratio = F.exp((F.col("a") - 1) * F.col("lp"))
    rows = grid.groupBy("a").agg(
        F.sum(w).alias("z"), F.sum(w * F.col("lp")).alias("m"),
        F.max(ratio).alias("most"), F.min(ratio).alias("least"))
    most = F.col("most") / F.col("least") if budget is None else F.col("most") / F.col("z") * F.lit(float(budget) / total)
    found = rows.select("a", (F.log("z") - F.col("a") * F.col("m") / F.col("z")).alias("h"), most.alias("e"))
    return sorted(tuple(r) for r in found.collect())  # one row per exponent


def _bisect(sources: DataFrame, budget: float | None, holds) -> tuple[float, float]:
    """(lo, hi) around the point in [0, 1] where ``holds(entropy, passes)`` turns."""
    lo, hi = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * k / PARTS for k in range(PARTS + 1)]
        flags = [holds(h, e) for _, h, e in _measure(sources, grid, budget)]
        if not flags or all(f == flags[0] for f in flags):
            return (hi, hi) if not flags or flags[0] else (lo, lo)
        turn = next(k for k in range(1, len(flags)) if flags[k] != flags[0])
        lo, hi = grid[turn - 1], grid[turn]
    return lo, hi


def exponent(sources: DataFrame, entropy: float | None, max_epochs: float | None, budget: float | None) -> float:
    """The exponent for ``sources(tokens)``; ``entropy`` is a share (0 to 1) of the most possible."""
    n = sources.filter("tokens > 0").count()
    if n == 0:
        return 1.0
    a = 1.0 if max_epochs is None else 0.0  # without an entropy: as flat as the limit allows
    if entropy is not None:
        goal = entropy * math.log(n) - 1e-12
        natural = _measure(sources, [1.0], budget)[0][1]
        a = 1.0 if natural >= goal else _bisect(sources, budget, lambda h, _: h >= goal)[0]
    if max_epochs is not None:
        if _measure(sources, [a], budget)[0][2] > max_epochs * (1 + 1e-9):
            a = max(a, _bisect(sources, budget, lambda _, e: e > max_epochs * (1 + 1e-9))[1])
    return a


def plan(
    keyed: DataFrame, entropy: float | None, max_epochs: float | None, budget: float | None,
    block_rows: int, seed: int,
) -> DataFrame:
    """One row per source: weight, epochs, whole passes, and the boundary of the partial pass."""
    sources = stage(keyed.groupBy("_s").agg(
        F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "sources")
    a = exponent(sources, entropy, max_epochs, budget)
    total = sources.agg(F.sum("tokens")).first()[0] or 1
    powered = sources.withColumn(
        "w", F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a))).otherwise(0.0))
    z, m = powered.agg(F.sum("w"), F.max(F.try_divide("tokens", "w"))).first()  # two numbers
    spend = float(m or 0.0) * float(z or 0.0) if budget is None else float(budget)
    weighted = powered.withColumn("weight", F.col("w") / F.lit(float(z or 1.0))).withColumn(
        "epochs", F.when(F.col("tokens") > 0, F.col("weight") * F.lit(spend) / F.col("tokens")).otherwise(1.0))
    near = F.round("epochs")  # rounding noise is no partial pass
    weighted = weighted.withColumn("epochs", F.when(F.abs(F.col("epochs") - near) < 1e-9, near).otherwise(F.col("epochs")))
    out = weighted.select(
        "_s", "tokens", "weight", "epochs", F.lit(a).alias("exponent"),
        F.floor("epochs").cast("int").alias("whole"),
        ((F.col("epochs") - F.floor("epochs")) * F.col("tokens")).alias("rest"),
        F.ceil(F.col("rows") / block_rows).cast("long").alias("n_blocks"))
    out = stage(out, "plan")
    partial = sized_broadcast(out.filter("rest > 0"))
    seen = keyed.join(partial, "_s").withColumn("bk", _block_key(seed, F.col("whole"), F.col("n_blocks")))
    by_block = Window.partitionBy("_s").orderBy("bk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = seen.groupBy("_s", "rest", "whole", "bk").agg(F.sum("n_tokens").alias("t")).withColumn(
        "before", F.coalesce(F.sum("t").over(by_block), F.lit(0)))
    edge = blocks.filter("before < rest").groupBy("_s", "whole", "rest").agg(
        F.max_by(F.struct("bk", "before"), "bk").alias("x")).select(
        "_s", "whole", F.col("x.bk").alias("bk"), (F.col("rest") - F.col("x.before")).alias("left"))
    edge = stage(edge, "edge")
    on_edge = keyed.join(sized_broadcast(out.select("_s", "n_blocks").join(edge, "_s")), "_s").filter(
        F.col("bk") == _block_key(seed, F.col("whole"), F.col("n_blocks")))
    by_row = Window.partitionBy("_s").orderBy("rk").rowsBetween(Window.unboundedPreceding, -1)
    rows = on_edge.groupBy("_s", "left", _row_key(seed, F.col("whole")).alias("rk")).agg(
        F.sum("n_tokens").alias("t")).withColumn("before", F.coalesce(F.sum("t").over(by_row), F.lit(0)))
    last = rows.filter("before < left").groupBy("_s").agg(F.max("rk").alias("edge_row"))
    return stage(out.join(edge.select("_s", F.col("bk").alias("edge_block")), "_s", "left").join(
        last, "_s", "left"), "mix-plan")


def _passes(rows: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """A row for each pass over each input row: epoch, block_key, row_key (the order of a pass)."""
    joined = rows.join(sized_broadcast(sources), "_s")
    bk, rk = _block_key(seed, F.col("whole"), F.col("n_blocks")), _row_key(seed, F.col("whole"))
    partial = F.coalesce((bk < F.col("edge_block")) | ((bk == F.col("edge_block")) & (rk <= F.col("edge_row"))), F.lit(False))
    n = F.col("whole") + partial.cast("int")
    out = joined.withColumn("_n", n).filter("_n > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return out.withColumn("block_key", _block_key(seed, F.col("epoch"), F.col("n_blocks"))).withColumn(
        "row_key", _row_key(seed, F.col("epoch")))


def mix(
    docs: DataFrame, entropy: float | None = 0.97, max_epochs: float | None = 4.0,
    budget: float | None = None, block_rows: int = 4096, seed: int = 42,
) -> DataFrame:
    """One row per document and pass: doc_id, source, n_tokens, epoch, block_key, row_key, weight,
    epochs, exponent. Sorted by (epoch, block_key, row_key), a source is read in training order."""
    keyed = stage(_keyed(docs), "keyed")
    sources = plan(keyed, entropy, max_epochs, budget, block_rows, seed)
    return _passes(keyed, sources, seed).select(
        "doc_id", "source", "n_tokens", "epoch", "block_key", "row_key", "weight", "epochs", "exponent")


def apply_mix(
    docs: DataFrame, entropy: float | None = 0.97, max_epochs: float | None = 4.0,
    budget: float | None = None, block_rows: int = 4096, seed: int = 42,
) -> DataFrame:
    """The documents themselves, each as often as its source's passes take it. Texts are read
    again and never shuffled."""
    keyed = stage(_keyed(docs), "keyed")
    sources = plan(keyed, entropy, max_epochs, budget, block_rows, seed)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      _source_key().alias("_s"), _row_hash().alias("_h"))
    return _passes(own, sources, seed).select("_row.*")
