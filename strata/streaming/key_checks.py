"""Primary-key and foreign-key checks kept current from new rows only.

Beside a table stands a summary of its key: one row per key value with its number of rows, in a table of key
buckets. A delivery is counted by itself and merged into the buckets that its keys fall in; nothing else of
the summary, and nothing of the table, is read.

* ``KeySummary.violations`` are the values seen more than once or holding a NULL, as
  ``operators.quality.key_violations`` gives them for the whole table;
* ``ForeignKey.orphans`` are the child's values without a parent, as ``operators.quality.orphans`` does. Both
  summaries have the same buckets, so the buckets that a child's or a parent's delivery hits are compared with
  each other and replaced, also where a parent that came late takes orphans away.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.buckets import BUCKETS, BucketTable

COUNT = "n_rows"


class KeySummary:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
        self.spark, self.keys = spark, list(keys)
        self.table = BucketTable(spark, path, keys, buckets)

    def add(self, rows: DataFrame, delivery: str) -> list[int]:
        """Count the ``rows`` of a delivery; returns the buckets they fall in. The name of a delivery again is a
        replay and adds nothing twice, as long as no other came in between."""
        new = rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(COUNT))
        hit = self.table.hit(rows)
        if not hit:
            return hit
        if self.table.exists() and not self.table.is_staged(delivery):
            new = self.table.read(hit).unionByName(new).groupBy(*self.keys).agg(F.sum(COUNT).alias(COUNT))
        self.table.replace(new, hit, delivery)
        return hit

    def violations(self) -> DataFrame:
        """Key values that break a primary key, with their number of rows."""
        some_null = reduce(Column.__or__, [F.col(k).isNull() for k in self.keys])
        return self.table.read().filter((F.col(COUNT) > 1) | some_null)


class ForeignKey:
    def __init__(self, spark: SparkSession, path: str, child: KeySummary, parent: KeySummary) -> None:
        """The parent's key columns are matched with the child's in order."""
        if child.table.buckets != parent.table.buckets:
            raise ValueError("child and parent need summaries of as many buckets")
        self.child, self.parent = child, parent
        self.table = BucketTable(spark, path, child.keys, child.table.buckets)

    def refresh(self, hit: Sequence[int], delivery: str) -> None:
        """Compare the buckets that a delivery of the child or the parent hit."""
        if not hit or not self.child.table.exists():
            return
        present = reduce(Column.__and__, [F.col(k).isNotNull() for k in self.child.keys])
        found = self.child.table.read(hit).filter(present)
        if self.parent.table.exists():
            parents = self.parent.table.read(hit).select(
                *[F.col(p).alias(c) for p, c in zip(self.parent.keys, self.child.keys)])
            found = found.join(parents, self.child.keys, "left_anti")
        self.table.replace(found, hit, delivery)

    def orphans(self) -> DataFrame:
        """Child key values without a parent, with their number of rows."""
        if not self.table.exists():
            return self.child.table.read().filter("false")
        return self.table.read()
