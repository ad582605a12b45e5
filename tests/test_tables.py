import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from strata.config import ENTITIES
from strata.operators.quality import schema_mismatches
from strata.sources.buckets import BucketTable
from strata.sources.tables import (
    TableStore, batch_folder, drain, list_names, merge_batches, read_snapshot, read_stream, remove,
    write_batch, write_clustered,
)


def _ranges(path):
    out = []
    for f in sorted(glob.glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(f).metadata
        if meta.num_rows == 0:
            continue
        stats = meta.row_group(0).column(0).statistics
        out.append((stats.min, stats.max))
    return out


def test_clustered_write_ranges_and_hot_key_split(spark, scratch):
    path = scratch("clustered")
    df = spark.range(4000).select(
        F.when(F.col("id") < 2000, F.lit(5)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    write_clustered(df, path, "k", num_files=8)
    assert read_snapshot(spark, path).count() == 4000
    ranges = _ranges(path)
    hot_files = [r for r in ranges if r == (5, 5)]
    assert len(hot_files) >= 2  # the hot key is split over several files
    others = sorted(r for r in ranges if r != (5, 5))
    for (lo1, hi1), (lo2, hi2) in zip(others, others[1:]):
        assert hi1 < lo2  # non-overlapping key ranges elsewhere


def test_table_store_catalog(spark, scratch):
    root = scratch("store")
    store = TableStore(root, database="t_store")
    ent = ENTITIES["customers"]
    store.declare(spark, "bronze", "bronze_customers", ent.table_properties("bronze"), "it's raw", ent.raw_schema())
    info = store.describe(spark, "bronze", "bronze_customers")
    assert info["properties"]["domain"] == "customers"
    assert info["properties"]["clustering.columns"] == "customer_id"
    assert info["comment"] == "it's raw"
    assert info["columns"] == list(ent.raw_columns)
    pii = [f.name for f in ent.raw_schema().fields if f.metadata.get("pii")]
    assert pii == ["customer_zip_code_prefix"]
    assert schema_mismatches(ent.raw_schema(), ent.raw_schema()) == []


def test_batches_are_clustered_and_merged(spark, scratch):
    merged = "spark.sql.adaptive.coalescePartitions.enabled"  # such small files would become one
    spark.conf.set(merged, "false")
    try:
        _clustered_and_merged(spark, scratch)
    finally:
        spark.conf.set(merged, "true")


def _clustered_and_merged(spark, scratch):
    path, out = scratch("batches") + "/t", scratch("batches-out")
    schema = "k long, v string"
    for i in range(5):
        rows = spark.range(i * 10, i * 10 + 1000).select(((F.col("id") * 7919) % 1000).alias("k"), F.lit(str(i)).alias("v"))
        write_batch(rows, path, i, "k")
    write_batch(spark.range(1000).select(F.col("id").alias("k"), F.lit("4").alias("v")), path, 4, "k")  # a replay
    whole = sorted(map(tuple, read_snapshot(spark, path).collect()))
    assert len(whole) == 5000
    for i in range(5):  # a key lies in one file of each batch
        ranges = _ranges(batch_folder(path, i))
        assert sum(lo <= 500 <= hi for lo, hi in ranges) == 1 < len(ranges)

    def read_new():
        seen = []
        drain(read_stream(spark, path, spark.createDataFrame([], schema).schema), f"{out}/_chk",
              lambda batch, i: seen.append(batch.count()))
        return sum(seen)

    assert read_new() == 5000
    assert not merge_batches(spark, path, "k", more_than=5) and merge_batches(spark, path, "k", more_than=3)
    assert [n for n in list_names(spark, path)] == ["m000000000004"]
    assert sorted(map(tuple, read_snapshot(spark, path).collect())) == whole
    assert read_new() == 0  # merged rows are no new rows
    write_batch(spark.createDataFrame([(1, "new")], schema), path, 5, "k")
    assert read_new() == 1 and read_snapshot(spark, path).count() == 5001
    # a merge that died before it deleted what it had merged, and a batch whose job did not end
    write_batch(spark.createDataFrame([(1, "old")], schema), path, 3, "k")
    os.makedirs(f"{path}/b000000000006")
    spark.range(1).select(F.col("id").alias("k"), F.lit("half").alias("v")).write.parquet(f"{path}/b000000000006/part")
    assert read_snapshot(spark, path).count() == 5001
    merge_batches(spark, path, "k")
    assert "b000000000003" not in list_names(spark, path) and "b000000000006" in list_names(spark, path)


def test_names_of_a_folder(spark, scratch):
    root = scratch("names")
    assert list_names(spark, f"{root}/none") == []
    remove(spark, f"{root}/none")
    os.makedirs(f"{root}/a/b")
    assert list_names(spark, root) == ["a"]
    remove(spark, f"{root}/a")
    assert list_names(spark, root) == []


def test_scratch_needs_a_shared_folder_off_local_masters(monkeypatch):
    from strata import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.scratch_root(Session())


def test_buckets_are_dealt_out_without_a_pass_for_ranges(spark, scratch, capsys):
    table = BucketTable(spark, f"{scratch('buckets')}/t", ["k"], buckets=4)
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    table._arranged(rows.withColumn("bucket", table.bucket())).explain()
    plan = capsys.readouterr().out
    assert "hashpartitioning(bucket" in plan and "rangepartitioning" not in plan
    table.replace(rows, table.hit(rows), "a")
    assert sorted(r.v for r in table.read().collect()) == list(range(100))
