"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position i gets a non-zero vector m(i) of ``radius + 1`` bits. Table v (each of
the 2^(radius+1) - 1 non-zero vectors) keeps the bits with <m(i), v> = 1. Two fingerprints
that differ in at most ``radius`` bits differ at positions whose vectors span at most
``radius`` dimensions, so some v is orthogonal to all of them: in that table both have the
same key. So no pair within the radius is missed, whatever the data (Pagh, "CoveringLSH").

Defined cases: null and empty texts and texts without a word have fingerprint 0 and link to
each other; equal texts have equal fingerprints; repeated rows come back once each; null ids
keep their rows and never name a component unless all its ids are null; an empty table gives
no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_rows, parts_for, stage, to_batch
from .graph import components

BITS = 64
#: A bucket with more distinct fingerprints is split further, exactly, instead of compared.
BUCKET_ROWS = 20_000


def fingerprint(text: str | None, shingle: int, seed: int = 42) -> int:
    """Bit is 1 if set in over half the XXH64 values of all word shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
    hashes = np.array([digest(line[s:e], seed) for s, e in spans], dtype="<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = np.unpackbits(hashes[at:at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, *more) with the fingerprint and the ``more`` columns as signed 64-bit integers."""

    def run(rows: dict[str, list]) -> dict[str, list]:
        own = np.array([fingerprint(t, shingle) for t in rows["text"]], np.uint64)
        return {"doc_id": rows["doc_id"], "fp": own.view(np.int64)} | {c: rows[c] for c in more}

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.col("text").cast("string").alias("text"), *more),
                    run, "doc_id long, fp long" + "".join(f", {c} long" for c in more))


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 table masks as signed 64-bit integers."""
    n = (1 << (radius + 1)) - 1
    vector = [1 + (i % n) for i in range(BITS)]
    masks = [sum(1 << i for i in range(BITS) if bin(vector[i] & v).count("1") & 1)
             for v in range(1, n + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _finer(mask: int, radius: int) -> list[int]:
    """Masks that split a bucket: its free bits fall into radius + 2 blocks, and a pair within
    the radius agrees on two of them at least, so each pair of blocks is kept in one mask."""
    mask &= (1 << BITS) - 1
    free = [i for i in range(BITS) if not mask >> i & 1]
    blocks = [sum(1 << i for i in free[b::radius + 2]) for b in range(radius + 2)]
    out = [mask | x | y for x, y in combinations(blocks, 2)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in out]


def forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join exactly what chains of pairs within ``radius`` join. Each fingerprint
    is compared with those not reached yet, so a dense group costs little more than its size;
    at most len(fps) - 1 links come out."""
    links: list[tuple[int, int]] = []
    rest = fps
    while len(rest) > 1:
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                found = rest[near]
                links += [(int(at), int(x)) for x in found]
                todo += list(found)
                rest = rest[~near]
    return links


_OUT = "mask long, a long, b long"


def _buckets(rows: DataFrame, radius: int, limit: int, n_parts: int) -> DataFrame:
    """Links of every bucket of ``rows(mask, fp)``; a bucket above ``limit`` comes back as its
    rows (mask set, a = fp) for the next, finer level."""
    keyed = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    dealt = keyed.repartition(n_parts, "mask", "key").sortWithinPartitions("mask", "key")
    target = arrow_schema(_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # of the group that may go on in the next batch
        now, size, over = None, 0, False

        def large(mask: int, fps: list[np.ndarray]) -> dict:
            own = np.concatenate(fps)
            return {"mask": np.full(len(own), mask), "a": own, "b": own}

        def small(fps: list[np.ndarray], out: list) -> None:
            own = np.unique(np.concatenate(fps).view(np.uint64))
            if len(own) > 1:
                out += forest(own, radius)

        def links(found: list) -> dict:
            pair = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            return {"mask": pa.nulls(len(pair), pa.int64()), "a": pair[:, 0], "b": pair[:, 1]}

        for batch in batches:
            mask, fp, key = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "fp", "key"))
            if not len(fp):
                continue
            cut = np.flatnonzero((mask[1:] != mask[:-1]) | (key[1:] != key[:-1])) + 1
            bounds = [0, *cut.tolist(), len(fp)]
            found: list[tuple[int, int]] = []
            for s, e in zip(bounds, bounds[1:]):
                if e - s == 1 and s and e < len(fp):
                    continue  # alone in its bucket
                if (group := (mask[s], key[s])) != now:
                    if held and not over and size > 1:
                        small(held, found)
                    held, size, over, now = [], 0, False, group
                held.append(fp[s:e])
                size += e - s
                if size > limit:
                    yield to_batch(large(int(mask[s]), held), target)
                    held, over = [], True
            if found:
                yield to_batch(links(found), target)
        if held and not over and size > 1:
            found = []
            small(held, found)
            yield to_batch(links(found), target)

    return dealt.select("mask", "fp", "key").mapInArrow(run, _OUT)


def near_links(distinct: DataFrame, radius: int, limit: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``distinct(fp)`` that connect exactly the
    chains of pairs within ``radius`` bits."""
    n = distinct.count()
    masks = F.array(*[F.lit(m).cast("long") for m in covering_masks(radius)])
    rows = distinct.select("fp", F.explode(masks).alias("mask"))
    least = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = None
    while True:
        n_parts = parts_for(n * 24 * 31, 64 << 20, least)
        done = stage(_buckets(rows, radius, limit, n_parts), "buckets")
        found = done.filter(F.col("mask").isNull()).select("a", "b")
        out = found if out is None else out.unionByName(found)
        large = done.filter(F.col("mask").isNotNull())
        levels = [r[0] for r in large.select("mask").distinct().collect()]  # masks, not rows
        if not levels:
            return out
        finer = F.map_from_arrays(
            F.array(*[F.lit(m).cast("long") for m in levels]),
            F.array(*[F.array(*[F.lit(x).cast("long") for x in _finer(m, radius)]) for m in levels]))
        rows = large.select(F.col("a").alias("fp"), F.explode(finer[F.col("mask")]).alias("mask")).distinct()


def near_dup_roots(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """``nodes``, one row per distinct fingerprint ``fp``, with ``root``: a fingerprint of the group that
    names it."""
    roots = components(near_links(nodes.select("fp"), radius))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        *[nodes[c] for c in nodes.columns], F.coalesce("root", "fp").alias("root"))


def simhash_near_dups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``.

    component_id is the smallest doc_id reachable by links of at most ``radius`` differing
    bits. Equal fingerprints are one node, so copies of a text never meet pair by pair."""
    fps = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    named = near_dup_roots(stage(nodes, "distinct-fingerprints"), radius)
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return fps.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dup_firsts(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, text_key) of one row of each group: the smallest doc_id (null last), then the smallest
    hash of the text. Rows are told apart by both, so rows that share an id are documents of their own.
    No row is joined with its group: minima per fingerprint, then per group, are combined map-side."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    fps = stage(fingerprints(keyed, shingle, ("text_key",)), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    nodes = stage(fps.groupBy("fp").agg(F.min(place).alias("first")), "distinct-fingerprints")
    return near_dup_roots(nodes, radius).groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.text_key")
