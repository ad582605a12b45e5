"""Approximate nearest neighbours by largest inner product: one small-world graph per shard.

1. Equal vectors are one node of a graph. A node needs no more than the smallest k + 1 of its ids (a list of
   k nearest can hold no others, even after the query's own is taken out), so a vector that a third of the
   rows share is k + 1 rows before it reaches a shard. The bound is exact, no row is lost to a result.
2. Distinct vectors are spread over shards of about ``shard_rows`` by hash. A task builds the graph of a shard
   (``hnsw.py``) and stores it as flat arrays: points, neighbours, ids. The index is a table of one row per
   shard, written to the shared folder.
3. Queries are packed into blocks. Each shard is searched once for each group of blocks: a task gets one
   index row and a bounded number of queries, whatever the number of queries or shards.
4. A shard gives its k best per query with products computed in double precision on the original vectors;
   the lists are merged by a window over (query, product, id).

Every query visits every shard: what moves and is computed is queries x shards, which grows with the square
of the table if the queries are a share of it. Larger shards lower it (a search costs about the logarithm
of the shard's rows); ``shard_rows`` is bounded by what a task may hold.

Results of odd input: rows whose id or vector is null, and vectors that are empty, zero or hold a null or
non-finite component, are neither queries nor candidates. Vectors of another length than the query's are
not compared with it. Repeated rows (id and vector equal) count once; an id with several vectors is a
candidate with each of them and a query with each of them, and all rows of the query's id are its own.
An empty table gives no rows. Other columns of the input are not read, whatever their names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import hnsw
from .common import arrow_schema, give_back, parts_for, small_batches, stage

#: Distinct vectors of a shard, queries of a block, blocks that one task searches a shard for.
SHARD_ROWS, BLOCK_ROWS, TASK_BLOCKS = 16_384, 512, 4
#: Neighbours kept by a node (twice as many on the lowest layer), beam of an insertion and of a search.
DEGREE, BUILD_BEAM, SEARCH_BEAM = 16, 96, 160

INDEX = ("dim int, shard int, sizes array<int>, widths array<int>, links binary, points binary, "
         "vectors binary, id_ends binary, ids binary")
FOUND = "query_id long, vec_id long, score double, own_hash long"


def usable(vector: Column) -> Column:
    """Not null, not empty, not all zero, every component a finite number."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _rows(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    element = table.schema[vector].dataType.elementType
    kind = "float" if isinstance(element, T.FloatType) else "double"
    rows = table.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{kind}>").alias("vector"))
    return rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector"))).distinct()


def _number(rows: DataFrame) -> str:
    return "float32" if isinstance(rows.schema["vector"].dataType.elementType, T.FloatType) else "float64"


def build_index(
    table: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS,
    degree: int = DEGREE, beam: int = BUILD_BEAM,
) -> DataFrame:
    """The index of all usable rows, for lists of up to ``k`` nearest: one row per shard."""
    rows = _rows(table, vec_id, vector)
    number = _number(rows)
    first = Window.partitionBy("vector").orderBy("vec_id")
    nodes = stage(rows.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k + 1).drop("rank"), "nodes")
    shards = parts_for(nodes.agg(F.count_distinct(F.xxhash64("vector"))).first()[0], shard_rows)
    sharded = nodes.withColumns({
        "dim": F.size("vector"), "shard": F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")})
    target = arrow_schema(INDEX)

    def built(key: tuple, group: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        ids = group.column("vec_id").to_numpy()
        flat = group.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim).astype(number)
        flat += 0.0  # -0.0 equals 0.0
        distinct, node = np.unique(flat, axis=0, return_inverse=True)
        order, graph = hnsw.build(distinct, degree, beam)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[node.reshape(-1)]
        by_place = np.lexsort((ids, place))
        out = {
            "dim": [dim], "shard": [key[1].as_py()], "sizes": [graph.sizes],
            "widths": [[x.shape[1] for x in graph.links]],
            "links": [b"".join(x.astype("<i4").tobytes() for x in graph.links)],
            "points": [graph.points.astype("<f4").tobytes()],
            "vectors": [distinct[order].tobytes()],
            "id_ends": [np.cumsum(np.bincount(place, minlength=len(order))).astype("<i8").tobytes()],
            "ids": [ids[by_place].astype("<i8").tobytes()],
        }
        give_back()
        return pa.Table.from_pydict(out, schema=target)

    small_batches(table.sparkSession)
    spread = sharded.repartitionByRange(shards, "dim", "shard")
    return stage(spread.groupBy("dim", "shard").applyInArrow(built, INDEX), "hnsw-index")


class Shard:
    """An index row, opened: its arrays are views of the row's bytes."""

    def __init__(self, row: dict, number: str) -> None:
        sizes, widths, dim = row["sizes"], row["widths"], row["dim"]
        flat, links, at = np.frombuffer(row["links"], "<i4"), [], 0
        for n, w in zip(sizes, widths):
            links.append(flat[at:at + n * w].reshape(n, w))
            at += n * w
        self.graph = hnsw.Graph(np.frombuffer(row["points"], "<f4").reshape(-1, dim + 1), sizes, links)
        self.vectors = np.frombuffer(row["vectors"], number).reshape(-1, dim)
        self.id_ends = np.frombuffer(row["id_ends"], "<i8")
        self.ids = np.frombuffer(row["ids"], "<i8")

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple:
        """(row of the query, id, product) of the k nearest per query that the graph finds, its own id left out."""
        found = self.graph.search(queries, beam)
        row, col = np.nonzero(found >= 0)
        node = found[row, col]
        score = np.einsum("ij,ij->i", queries[row].astype(np.float64), self.vectors[node].astype(np.float64))
        ends = self.id_ends[node]
        starts = np.where(node > 0, self.id_ends[np.maximum(node - 1, 0)], 0)
        n = ends - starts
        each = np.repeat(np.arange(len(node)), n)
        ids = self.ids[np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + starts[each]]
        row, score = row[each], score[each]
        other = ids != query_ids[row]
        row, ids, score = row[other], ids[other], score[other]
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        first = np.searchsorted(row, row)  # where the query's rows begin
        best = np.arange(len(row)) - first < k
        return row[best], ids[best], score[best]


def search(
    index: DataFrame, table: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding",
    beam: int = SEARCH_BEAM, block_rows: int = BLOCK_ROWS, task_blocks: int = TASK_BLOCKS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest candidates of ``index`` for each usable row of ``table``
    that ``is_query`` holds for, nearest first, ties to the smaller id. ``index`` must be built for ``k`` or more."""
    queries = stage(_rows(table.filter(is_query), vec_id, vector), "queries")
    number = _number(queries)
    blocks = parts_for(queries.count(), block_rows)
    shards = (index.agg(F.max("shard")).first()[0] or 0) + 1
    lanes = parts_for(blocks, task_blocks)
    own = F.xxhash64("vec_id", "vector")
    packed = queries.withColumns({
        "dim": F.size("vector"), "block": F.pmod(own, F.lit(blocks)).cast("int")}).groupBy("dim", "block").agg(
        F.collect_list(F.struct("vec_id", own.alias("own_hash"), "vector")).alias("queries"))
    lane = F.pmod(F.col("block"), F.lit(lanes)).cast("int").alias("lane")
    asked = packed.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), lane, "queries")
    held = index.select(*index.columns, F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    key = ("dim", "shard", "lane")
    target = arrow_schema(FOUND)

    def answered(blocks: pa.Table, index_row: pa.Table) -> pa.Table:
        if not blocks.num_rows or not index_row.num_rows:
            return target.empty_table()
        graph = Shard(index_row.to_pylist()[0], number)
        out = []
        for batch in blocks.column("queries").chunks:
            for block in range(len(batch)):
                some = batch.slice(block, 1).flatten()
                ids = some.field("vec_id").to_numpy()
                hashes = some.field("own_hash").to_numpy()
                vectors = some.field("vector").flatten().to_numpy().reshape(len(ids), -1).astype(number)
                row, found, score = graph.nearest(ids, vectors, k, beam)
                out.append(pa.Table.from_arrays([pa.array(c) for c in (ids[row], found, score, hashes[row])], schema=target))
        give_back()
        return pa.concat_tables(out)

    small_batches(index.sparkSession)
    tasks = shards * lanes
    found = asked.repartition(tasks, *key).groupBy(*key).cogroup(
        held.repartition(tasks, *key).groupBy(*key)).applyInArrow(answered, FOUND)
    nearest = Window.partitionBy("query_id", "own_hash").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def nearest_neighbours(
    table: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
    shard_rows: int = SHARD_ROWS, **search_options,
) -> DataFrame:
    """Index all rows of ``table`` and search them for the rows that ``is_query`` holds for."""
    index = build_index(table, k, vec_id, vector, shard_rows)
    return search(index, table, is_query, k, vec_id, vector, **search_options)
