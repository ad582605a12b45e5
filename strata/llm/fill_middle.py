"""Fill-in-the-middle transformation by regular expressions with counted quantifiers.

``regexp_count`` gives the number n of units (lines) of a text. Hashes of the document id choose two
cuts a <= b among the n + 1 places between units. The pattern of a row, ``(unit{a})(unit{b-a})(.*)``
with possessive groups, then captures prefix, middle and suffix in one match, and the replacement of
that match is the output. A possessive group runs in a loop and keeps no way back, so a text of a
million lines needs no more stack or memory than one of two.

Everything is one projection of Spark functions: no shuffle, no state, a row at a time, so neither a
hot source nor copies nor long texts matter to the plan.

Results of odd input: a null text counts as empty; an empty text and a text that holds one of the
markers stay plain (the markers could not be told from the text's own); a null doc_id is hashed like an
empty one; repeated rows give repeated rows; an empty table gives no rows. Other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a line with its end, or the rest of the text without one.
UNIT = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers: the first four 8-digit groups of sha256("seed:doc_id")."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _pattern(first: Column, second: Column) -> Column:
    """``first`` units, ``second`` units and the rest, each in a group. Units and counts are possessive."""
    unit = r"(?:[^\n]*+\n|[^\n]++)"
    times = [F.concat(F.lit(f"({unit}{{"), n.cast("string"), F.lit("}+)")) for n in (first, second)]
    return F.concat(F.lit(r"\A"), *times, F.lit(r"((?s:.*+))\z"))


def fill_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, spm_share: int = 50,
) -> DataFrame:
    """(doc_id, n, form, prefix_units, middle_units, output) of each row.

    ``rate`` per cent of the documents are transformed, ``spm_share`` per cent of those with the suffix
    first; both are drawn by hash of ``seed`` and doc_id, so the choice is the same on every run and
    cluster. ``n`` counts units; ``prefix_units`` and ``middle_units`` are null for plain rows."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    h = _draws(F.col("doc_id"), seed)
    rows = rows.withColumns({
        "n": F.regexp_count("text", F.lit(UNIT)).cast("long"),
        "_1": h[0], "_2": h[1], "_3": h[2] % 100, "_4": h[3] % 100,
    })
    plain = (F.col("text") == "") | F.col("text").rlike(MARKER) | (F.col("_3") >= rate)
    cuts = [F.col(c) % (F.col("n") + 1) for c in ("_1", "_2")]
    rows = rows.withColumns({
        "form": F.when(plain, "plain").when(F.col("_4") < spm_share, "spm").otherwise("psm"),
        "_a": F.least(*cuts), "_b": F.greatest(*cuts),
    })
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(
        f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    cut = F.regexp_replace(F.col("text"), _pattern(F.col("_a"), F.col("_b") - F.col("_a")), order)
    whole = F.col("form") == "plain"
    return rows.select(
        "doc_id", "n", "form",
        F.when(~whole, F.col("_a")).alias("prefix_units"),
        F.when(~whole, F.col("_b") - F.col("_a")).alias("middle_units"),
        F.when(whole, F.col("text")).otherwise(cut).alias("output"))


def parts(output: Column, form: Column) -> Column:
    """Struct (prefix, middle, suffix) of an output, null for a plain one. The text of a transformed
    row holds no marker, so the output holds each exactly once."""
    pieces = F.split(output, MARKER, -1)  # what stands before the first marker is empty
    last = F.get(pieces, F.lit(3))
    second, third = F.get(pieces, F.lit(1)), F.get(pieces, F.lit(2))
    spm = form == "spm"
    return F.when(form != "plain", F.struct(
        F.when(spm, third).otherwise(second).alias("prefix"),
        last.alias("middle"),
        F.when(spm, second).otherwise(third).alias("suffix")))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    p = parts(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(p["prefix"], p["middle"], p["suffix"]))


def digest(rows: DataFrame) -> DataFrame:
    """Lengths in code points and checksums of ``fill_middle``'s rows; the restored text is rebuilt
    from the output."""
    p = parts(F.col("output"), F.col("form"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select(
        "doc_id", "n", "form",
        F.length(p["prefix"]).cast("long").alias("prefix_chars"),
        F.length(p["middle"]).cast("long").alias("middle_chars"),
        sha(F.col("output")).alias("output_sha256"),
        sha(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
