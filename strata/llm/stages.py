"""Operators as pipeline steps: documents in, documents out, all columns kept.

A document is known by its doc_id and text: rows that share an id and hold different texts are
documents of their own. What a step gives for odd input:

* ``drop_near_dups``: null and empty texts and texts without a word are one group (their fingerprint
  is 0); in a group the smallest doc_id stays, a null id only if the group has no other, and of rows
  with that id the one whose text has the smallest hash; repeated rows give one row (any of those
  that are equal in id and text); the result does not depend on the order of the rows.
* ``drop_contaminated``: null and empty texts stay; repeated rows stay or go together.

Empty tables give no rows. The columns of the input travel as one value, so none of their names can
clash with a step's own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.joins import sized_broadcast

from .decontaminate import decontaminate
from .simhash import near_dup_firsts


def _key() -> Column:
    stand_in = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), stand_in)


def _whole(docs: DataFrame) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def drop_near_dups(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One document of each near-duplicate group of SimHash. Rows are dealt out once, by id and text."""
    key = [F.col("doc_id").isNull().alias("_none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id")]
    names = ["_none", "_id", "_text"]
    first = near_dup_firsts(docs, shingle, radius).select(*key, F.col("text_key").alias("_text"))
    rows = docs.select(_whole(docs), *key, F.xxhash64("text").alias("_text"))
    return rows.join(first, names, "left_semi").dropDuplicates(names).select("_row.*")


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows that the benchmark does not contaminate; clean ones stay as they are."""
    key = F.xxhash64(_key(), "text")
    verdicts = decontaminate(docs.select(key.alias("doc_id"), "text"), items)
    gone = verdicts.filter("contaminated").select(F.col("doc_id").alias("_key")).distinct()
    rows = docs.select(_whole(docs), key.alias("_key"))
    return rows.join(sized_broadcast(gone), "_key", "left_anti").select("_row.*")
