"""Stored layer tables: Parquet folders under one base path per layer.

* ``write_batch`` / ``append_batches``: the append sink of a streaming table. A micro-batch is one
  folder, range-partitioned and sorted by the clustering key, so the min/max statistics of its files
  cover narrow key ranges and key filters skip files. A replayed batch overwrites its own folder.
* ``merge_batches``: many small batch folders become one clustered folder.
* ``read_stream`` / ``read_snapshot``: such a table as a stream of new batches, or all its rows.
* ``append_stream``: Spark's plain file sink, run once over everything new (``availableNow``).
* ``write_clustered``: any table in the clustered layout.
* ``TableStore``: names to paths; properties and comments are stored in the session's catalog as an
  external table over the folder.

Tables that are changed in place are in ``strata.sources.buckets``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strata.session import JOIN_STATE_CONF, UNCOUNTED_STATE_CONF, hadoop_fs, settings
from strata.sources.csv_feed import MAX_BYTES_PER_TRIGGER


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class TableStore:
    """Folder layout ``<base>/<layer>/<table>``; catalog database ``<database>_<layer>``."""

    base: str
    database: str = "strata"
    layers: dict[str, str] = field(
        default_factory=lambda: {"bronze": "bronze", "silver": "silver", "gold": "gold"}
    )

    def path(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/{self.layers[layer]}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{self.layers[layer]}/{name}"

    def counts(self, layer: str, name: str) -> str:
        return f"{self.base.rstrip('/')}/_counts/{self.layers[layer]}/{name}"

    def table(self, layer: str, name: str) -> str:
        return f"`{self.database}_{self.layers[layer]}`.`{name}`"

    def declare(
        self,
        spark: SparkSession,
        layer: str,
        name: str,
        properties: dict[str, str] | None = None,
        comment: str = "",
        schema: T.StructType | None = None,
    ) -> str:
        """Register the table in the session's catalog with its properties and comment. The
        schema is the stored one unless given (then the folder may still be empty)."""
        path = self.path(layer, name)
        if schema is None:
            schema = read_snapshot(spark, path).schema
        hadoop_path, fs = hadoop_fs(spark, path)
        fs.mkdirs(hadoop_path)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        pairs = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in sorted((properties or {}).items()))
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}_{self.layers[layer]}`")
        spark.sql(f"DROP TABLE IF EXISTS {self.table(layer, name)}")  # external: the data stay
        spark.sql(
            f"CREATE TABLE {self.table(layer, name)} ({columns}) USING parquet "
            f"OPTIONS (recursiveFileLookup 'true') LOCATION {_sql_text(path)} COMMENT {_sql_text(comment)} "
            + (f"TBLPROPERTIES ({pairs})" if pairs else ""))
        return path

    def declare_view(
        self,
        spark: SparkSession,
        layer: str,
        name: str,
        folder: str,
        columns: list[str],
        properties: dict[str, str],
        comment: str = "",
    ) -> None:
        """Register the ``columns`` of a folder with partitions as a view, with its properties."""
        pairs = ", ".join(f"{_sql_text(k)} = {_sql_text(v)}" for k, v in sorted(properties.items()))
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}_{self.layers[layer]}`")
        names = ", ".join(f"`{c}`" for c in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {self.table(layer, name)} COMMENT {_sql_text(comment)} "
                  f"TBLPROPERTIES ({pairs}) AS SELECT {names} FROM parquet.`{folder}`")

    def properties(self, spark: SparkSession, layer: str, name: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {self.table(layer, name)}").collect()}

    def describe(self, spark: SparkSession, layer: str, name: str) -> dict:
        """path, properties, comment and columns of a declared table."""
        info = {r["col_name"]: r["data_type"] for r in spark.sql(
            f"DESCRIBE TABLE EXTENDED {self.table(layer, name)}").collect()}
        return {
            "path": self.path(layer, name),
            "comment": info.get("Comment", ""),
            "properties": self.properties(spark, layer, name),
            "columns": spark.table(self.table(layer, name)).columns,
        }


# -- batch folders ---------------------------------------------------------------------------

_BATCH, _MERGED = re.compile(r"b(\d{12})"), re.compile(r"m(\d{12})")


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/b{batch_id:012d}"


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a Spark job has written ``folder`` to its end (Spark's own marker file)."""
    return "_SUCCESS" in list_names(spark, folder)


def table_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders with the rows of a table of batch folders: the latest merged one and the batches after
    it. A folder whose job did not end is left out: its batch will be replayed. ``path`` itself for a
    table without batch folders."""
    names = list_names(spark, path)
    if not any(_BATCH.fullmatch(n) or _MERGED.fullmatch(n) for n in names):
        return [path]
    merged = [n for n in names if _MERGED.fullmatch(n) and is_complete(spark, f"{path}/{n}")]
    upto = int(merged[-1][1:]) if merged else -1
    batches = [n for n in names if _BATCH.fullmatch(n) and int(n[1:]) > upto and is_complete(spark, f"{path}/{n}")]
    return [f"{path.rstrip('/')}/{n}" for n in [*merged[-1:], *batches]]


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All rows of a stored table."""
    folders = table_folders(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if not folders and schema is not None:
        return spark.createDataFrame([], schema)
    return reader.parquet(*folders)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    max_bytes_per_trigger: int = MAX_BYTES_PER_TRIGGER,
) -> DataFrame:
    """New batches of a table of batch folders as a stream (schema taken from the table if omitted), in
    micro-batches of bounded size. Merged folders hold no new rows and are not looked at."""
    if schema is None:
        schema = read_snapshot(spark, path).schema
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", str(max_bytes_per_trigger)).parquet(
        f"{path.rstrip('/')}/b*")


def stream_in_batches(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """A stored table as a stream of about ``batches`` micro-batches, by shares of its files."""
    stored = spark.read.parquet(path)
    files = max(1, math.ceil(len(stored.inputFiles()) / batches))
    return spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", str(files)).parquet(path)


def drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give every new micro-batch of ``stream`` to ``each(batch, batch_id)`` and block until all are done
    (``availableNow``). ``each`` must end the same way when it gets a batch again after a failure."""
    return run_once(
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        .foreachBatch(each).start())


def clustered(df: DataFrame, *cluster_by: str, num_files: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted on ``cluster_by``.

    A row hash is the last range column, so a key that holds a large share of the rows is split over
    several partitions (each with min = max = that key) instead of one task. Without ``num_files`` the
    adaptive execution merges neighbouring partitions to its advisory size once it knows their bytes, so
    the number of files follows the data without a pass that measures them."""
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    by = [*cluster_by, "__spread"]
    df = df.withColumn("__spread", spread)
    df = df.repartitionByRange(num_files, *by) if num_files else df.repartitionByRange(*by)
    return df.sortWithinPartitions(*cluster_by).drop("__spread")


def write_batch(batch: DataFrame, path: str, batch_id: int, cluster_by: str) -> None:
    """One micro-batch as its own clustered folder; a replay overwrites it."""
    clustered(batch, cluster_by).write.mode("overwrite").parquet(batch_folder(path, batch_id))


def append_batches(
    stream: DataFrame, path: str, checkpoint: str, cluster_by: str,
    first: Callable[[DataFrame, int], DataFrame] | None = None,
    then: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Append every new row of ``stream`` to the table at ``path`` once, each batch clustered.
    ``first(batch, batch_id)`` may look at a batch and give what is to be stored; ``then(batch_id)`` runs
    when it is."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(first(batch, batch_id) if first else batch, path, batch_id, cluster_by)
        if then:
            then(batch_id)

    return drain(stream, checkpoint, each)


def merge_batches(spark: SparkSession, path: str, cluster_by: str, more_than: int = 32) -> bool:
    """Merge the folders of a table into one clustered folder if there are more than ``more_than`` of them;
    whether it was done. Only for tables whose readers have seen all batches. Readers of the table see the
    old folders until the merged one is complete; what it replaces is deleted afterwards, by the next call
    if this one dies before."""
    folders = table_folders(spark, path)
    last = max((int(f.rsplit("/", 1)[1][1:]) for f in folders if f != path), default=-1)
    merge = folders != [path] and len(folders) > more_than
    if merge:
        clustered(spark.read.parquet(*folders), cluster_by).write.mode("overwrite").parquet(f"{path}/m{last:012d}")
    held = {f.rsplit("/", 1)[1] for f in table_folders(spark, path)}
    merged = max((int(n[1:]) for n in held if _MERGED.fullmatch(n)), default=-1)
    for name in list_names(spark, path):
        known = _BATCH.fullmatch(name) or _MERGED.fullmatch(name)
        if known and name not in held and int(name[1:]) <= merged:
            remove(spark, f"{path}/{name}")
    return merge


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    query_name: str | None = None,
    count_state: bool = True,
) -> StreamingQuery:
    """Append every new row of ``df`` to the Parquet table at ``path`` once, by Spark's file sink.

    The sink logs committed files under ``_spark_metadata``, so a batch replayed after a failure is not
    written twice and readers never see half a batch. Join state is kept as ``JOIN_STATE_CONF`` says;
    ``count_state`` False leaves the number of its rows out of the progress, which makes writes cheaper.
    """
    writer = (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .format("parquet")
    )
    if query_name:
        writer = writer.queryName(query_name)
    with settings(df.sparkSession, JOIN_STATE_CONF | ({} if count_state else UNCOUNTED_STATE_CONF)):
        return writer.start(path)


def run_once(query: StreamingQuery) -> StreamingQuery:
    """Block until an ``availableNow`` query has drained its input; re-raise failures."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def write_clustered(
    df: DataFrame, path: str, cluster_by: str, num_files: int | None = None, mode: str = "overwrite",
) -> None:
    """Write ``df`` in the clustered layout (see ``clustered``)."""
    clustered(df, cluster_by, num_files=num_files).write.mode(mode).parquet(path)


# -- folders through Hadoop's file system -----------------------------------------------------


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist. Any other error is raised."""
    hadoop_path, fs = hadoop_fs(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds."""
    hadoop_path, fs = hadoop_fs(spark, path)
    if fs.exists(hadoop_path) and not fs.delete(hadoop_path, True):
        raise OSError(f"could not delete {path}")
