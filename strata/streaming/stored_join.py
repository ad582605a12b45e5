"""Inner joins of streams that keep what has come as plain Parquet.

A join of streams without a watermark has to keep every row. Spark's own keeps it once a join, each time with the
columns of the joins before, in a key-value store and again in that store's checkpoint. Here every stream's rows
are stored once, a folder per micro-batch, and a micro-batch joins what is new with what was there (a delta join):
an inner join of ``A`` and ``B`` that become ``A + a`` and ``B + b`` gains ``a x B``, ``(A + a) x b``, and so on for
more streams. Each of these terms is an ordinary batch join, so large ones are shuffled, small sides broadcast and
hot keys split as in any other.

A replayed micro-batch overwrites its own folders with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.joins import broadcast_fits
from strata.session import LEAN_CONF, settings
from strata.sources.tables import batch_folder, drain, read_snapshot

SIDE = "__side"


class StoredJoin:
    """``join(**sides)`` of streams, kept under ``root``. ``join`` must be made of inner joins, filters and
    projections: its rows for a side that grows are those of the side before and those of what is new.

    ``links`` says by which column a side refers to another, ``{(side, other): column}``: when what is new of
    ``other`` is small, only the rows of ``side`` that refer to it take part in its term."""

    def __init__(
        self, spark: SparkSession, root: str, join: Callable[..., DataFrame],
        links: dict[tuple[str, str], str] | None = None,
    ) -> None:
        self.spark, self.root, self.join, self.links = spark, root.rstrip("/"), join, links or {}

    def run(self, streams: dict[str, DataFrame]) -> None:
        """Drain the streams in one query (``availableNow``), whose checkpoint tells which rows have come. The
        largest stream comes last: what is new of it meets the others as they are now, once."""
        tagged = [s.select(F.lit(name).alias(SIDE), F.struct(*s.columns).alias(name)) for name, s in streams.items()]
        news = tagged[0]
        for s in tagged[1:]:
            news = news.unionByName(s, allowMissingColumns=True)
        schemas = {name: s.schema for name, s in streams.items()}

        def each(batch: DataFrame, batch_id: int) -> None:
            for name in schemas:
                batch.filter(F.col(SIDE) == name).select(f"{name}.*").write.mode("overwrite").parquet(
                    batch_folder(f"{self.root}/{name}", batch_id))

            def rows(name: str, first: int, until: int) -> DataFrame:
                folders = [batch_folder(f"{self.root}/{name}", n) for n in range(first, until)]
                reader = self.spark.read.schema(schemas[name])
                return reader.parquet(*folders) if folders else self.spark.createDataFrame([], schemas[name])

            for k, name in enumerate(schemas):
                if batch_id == 0 and k < len(schemas) - 1:
                    continue  # nothing was there yet
                # sides before this one as they are now, those after it as they were
                sides = {n: rows(n, 0, batch_id + (i < k)) for i, n in enumerate(schemas)}
                sides[name] = rows(name, batch_id, batch_id + 1)
                if batch_id and sides[name].isEmpty():
                    continue
                self._cut(sides, name)
                self.join(**sides).write.mode("overwrite").parquet(
                    batch_folder(f"{self.root}/out", batch_id * len(schemas) + k))

        with settings(self.spark, LEAN_CONF):
            drain(news, f"{self.root}/_chk", each)

    def _cut(self, sides: dict[str, DataFrame], new: str) -> None:
        for (name, other), column in self.links.items():
            if other == new:
                keys = sides[new].select(column)
                if broadcast_fits(keys):
                    sides[name] = sides[name].join(F.broadcast(keys), column, "left_semi")

    def read(self) -> DataFrame:
        """All joined rows so far."""
        return read_snapshot(self.spark, f"{self.root}/out")
