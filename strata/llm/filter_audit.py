"""Filter interaction audit by the Hart-Mas-Colell potential of the removal game.

Players are the filters; the worth v(S) of a coalition S is the number of documents that fail at least
one filter of S, that is what S removes in whatever order. The documents reach the audit as counts per
(part, set of failed filters), at most 32 rows a part, and everything after that is arithmetic on arrays
of 32 numbers:

* coalition values v(S) from the counts;
* potentials, smallest coalitions first: P({}) = 0, P(S) = (v(S) + sum of P(S - i) over i in S) / |S|.
  They are kept whole as Q(S) = |S|! P(S), so Q(S) = (|S| - 1)! v(S) + sum of Q(S - i);
* the Shapley value of a filter is P(all) - P(all without it); times k! it is Q(all) - k Q(all without it);
* what step ``f`` of an order removes after the filters S is v(S + f) - v(S), the same difference of the
  games of good and of toxic documents gives what is lost.

The order of filters never touches a document: 120 orders cost as much as one.

Moving data: texts are read once and become a row of about 60 bytes (id, part, flags, sha256 of the text).
Copies are found by the smallest id per checksum, combined before the shuffle. Rows are summed before each
join so that its keys are even by construction: per (checksum, id) the rows of one part and flag set are
one row, per id at most 32 rows a part. A hot source, a text that a third of the documents share and a
repeated id are therefore sums, not groups.

Results of odd input: a null text counts as empty; a null source is the part ''; a null doc_id has no
smaller id, is smaller than none and has no labels; rows that repeat an id are documents of their own,
copies of a text under one id are not smaller than each other; a document is good (toxic) if one of its
label rows says 1; labels of unknown ids count nowhere; an empty table gives no rows. Other columns of
the input are not read, whatever their names.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Filters of ``failed_filters``, in the order of their bits.
NAMES = "ABCDE"
_BLANK = r"[\x20\x09-\x0D]+"


def text_failures(
    text: Column, min_words: int = 200, distinct_percent: int = 50, upper_percent: int = 2,
    symbols: str = "#$%&*|",
) -> Column:
    """Bits 0 to 3: few words, few distinct words, many capitals, a symbol that must not occur."""
    words = F.array_remove(F.split(text, _BLANK), "")
    fails = [
        F.size(words) < min_words,
        100 * F.size(F.array_distinct(words)) < distinct_percent * F.size(words),
        100 * F.regexp_count(text, F.lit("[A-Z]")) > upper_percent * F.length(text),
        text.rlike("[" + "".join("\\" + s for s in symbols) + "]"),
    ]
    mask = F.lit(0)
    for bit, fail in enumerate(fails):
        mask = mask + F.when(fail, 1 << bit).otherwise(0)
    return mask


def failed_filters(docs: DataFrame, labels: DataFrame, **limits) -> DataFrame:
    """(part, mask, n, good, toxic): documents per part and set of failed filters, and how many of them
    are labelled good and toxic. Bit 4 of ``mask``: a smaller doc_id of the table has the same text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stage(docs.select(
        "doc_id", F.coalesce(F.col("source"), F.lit("")).alias("part"),
        text_failures(text, **limits).alias("mask"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha")), "filter-flags")

    known = rows.filter("doc_id IS NOT NULL")
    first = known.groupBy("sha").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    by_text = known.groupBy("sha", "doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    copied = F.when(F.col("first").isNull(), 1 << 4).otherwise(0)
    by_id = by_text.join(first, ["sha", "doc_id"], "left").groupBy(
        "doc_id", "part", (F.col("mask") + copied).alias("mask")).agg(F.sum("n").alias("n"))

    said = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).cast("long")
    marks = labels.groupBy("doc_id").agg(said("quality").alias("good"), said("toxic").alias("toxic"))
    marked = by_id.join(marks, "doc_id", "left").select(
        "part", "mask", "n", *[(F.col("n") * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in ("good", "toxic")])
    unknown = rows.filter("doc_id IS NULL").select(
        "part", "mask", F.lit(1).cast("long").alias("n"), *[F.lit(0).cast("long").alias(c) for c in ("good", "toxic")])
    return marked.unionByName(unknown).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def coalition_values(counts: Column, k: int) -> Column:
    """v(S) for S = 0 .. 2^k - 1, from an array of documents per set of failed filters."""
    return F.transform(F.sequence(F.lit(0), F.lit(2**k - 1)), lambda s: F.aggregate(
        F.sequence(F.lit(0), F.lit(2**k - 1)), F.lit(0).cast("long"),
        lambda total, m: total + F.when(s.bitwiseAND(m) != 0, F.get(counts, m)).otherwise(0)))


def potentials(values: Column, k: int) -> Column:
    """|S|! P(S) for S = 0 .. 2^k - 1: whole numbers, each from the coalitions with one filter less."""
    below = F.array(*[F.lit(factorial(max(0, n - 1))).cast("long") for n in range(k + 1)])
    bits = F.array(*[F.lit(1 << i) for i in range(k)])

    def grow(found: Column, s: Column) -> Column:
        smaller = F.aggregate(bits, F.lit(0).cast("long"), lambda total, bit: total + F.when(
            s.bitwiseAND(bit) != 0, F.get(found, s - bit)).otherwise(0))
        own = F.get(below, F.bit_count(s)) * F.get(values, s)
        return F.concat(found, F.array(own + smaller))

    return F.aggregate(F.sequence(F.lit(1), F.lit(2**k - 1)), F.array(F.lit(0)).cast("array<long>"), grow)


def interaction_audit(failed: DataFrame, names: str = NAMES) -> DataFrame:
    """One row per part, order of the filters and step, zeros included, from ``failed(part, mask, n, good,
    toxic)`` with bit i of ``mask`` for the i-th of at most 8 one-letter ``names``: the counts kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, and shapley (the value times the number of orders)."""
    k = len(names)
    if not 1 <= k <= 8 or len(set(names)) != k:
        raise ValueError("names must be one to eight different letters")
    whole = 2**k - 1
    by_part = failed.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).groupBy(
        "part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("by_mask"))

    def counts(name: str) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(whole)), lambda m: F.coalesce(
            F.try_element_at(F.col("by_mask"), m)[name], F.lit(0).cast("long")))

    games = by_part.select("part", *[counts(c).alias(f"_{c}") for c in ("n", "good", "toxic")])
    games = games.select(
        "part", F.aggregate("_n", F.lit(0).cast("long"), lambda a, b: a + b).alias("total"),
        *[coalition_values(F.col(f"_{c}"), k).alias(c) for c in ("n", "good", "toxic")])
    games = games.withColumn("potential", potentials(F.col("n"), k))

    orders = ",".join(sorted("".join(p) for p in permutations(names)))
    steps = games.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(k))))

    def bits(letters: Column) -> Column:
        return sum((F.when(F.instr(letters, name) > 0, 1 << i).otherwise(0) for i, name in enumerate(names)), F.lit(0))

    steps = steps.withColumns({
        "before": bits(F.expr("substring(filter_order, 1, step - 1)")),
        "own": bits(F.expr("substring(filter_order, step, 1)")),
    })
    after = F.col("before") + F.col("own")
    rest = F.lit(whole) - F.col("own")
    lost = lambda game: F.get(F.col(game), after) - F.get(F.col(game), F.col("before"))
    return steps.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("n", after)).alias("kept"),
        lost("n").alias("removed"),
        (F.get("n", F.col("own")) - lost("n")).alias("redundant"),
        (F.get("n", F.lit(whole)) - F.get("n", rest)).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        (F.get("potential", F.lit(whole)) - k * F.get("potential", rest)).alias("shapley"))
