"""Training-data pipeline: five operators over ``documents``, each stage written and read again.

Each stage gets all that its predecessor kept. All but the last return the columns of documents, whatever
further columns there are and however they are named; the last writes the token store, reads it back and
returns its documents. Every stage takes an empty table and gives none back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import stage, table
from strata.llm.language import keep_known
from strata.llm.mixing import apply_mix
from strata.llm.queries import token_roundtrip
from strata.llm.stages import drop_contaminated, drop_near_dups

#: A document stays if a language is predicted for it with at least this score.
MIN_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty texts among them) and those whose language is not
    clear. Repeated rows stay or go together; a null doc_id is judged, but not learned from."""
    return keep_known(docs, MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each SimHash group (4-word shingles, 4 bits): the smallest doc_id, null last, and of rows
    with that id the text with the smallest hash. Texts without a word are one group; rows that share an id and
    hold different texts are documents of their own."""
    return drop_near_dups(docs, shingle=4, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of which at least 5 % of the words lie in benchmark windows. Null and empty texts stay;
    rows that share an id are judged each for itself; an empty benchmark drops nothing."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats small sources towards the target weights; every document stays at least once. A null source is a
    source; repeated rows are rows of their own."""
    return apply_mix(docs, entropy=0.97, max_epochs=4.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token store and returns doc_id, start, n_tokens, ids_crc32 as read from it. Null and empty texts
    give the end id alone; null ids come first, rows with one id in the order of their texts."""
    return token_roundtrip(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("tokens", tokens),
]

#: Trained models and hashes decide; SQL cannot express the stages (tests compare with brute force).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
