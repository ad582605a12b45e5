"""Registered queries of the text operators: thin wrappers with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_dir

from .common import table
from .decontaminate import decontaminate
from .fill_middle import digest, fill_middle
from .filter_audit import failed_filters, interaction_audit
from .language import detect
from .licenses import scan_licenses
from .mixing import mix
from .neighbours import nearest_neighbours
from .quality_rules import quality_rules
from .rule_ensemble import quality_scores
from .simhash import simhash_near_dups
from .substring import remove_repeats
from .token_store import read_tokens, write_tokens
from .toxicity import toxicity_scores


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), entropy=0.97, max_epochs=4.0)


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), size=13)


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents"))


def op4_simhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dups(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


#: Id that ends a document, and the public tokenizer (its file stays where it is installed).
END_ID, TOKENIZER = 2, "byte_bpe_50k.json"


def token_roundtrip(docs: DataFrame) -> DataFrame:
    """Write ``docs`` to a token store in the shared folder and read it back."""
    import public_tokenizers

    spark = docs.sparkSession
    root = scratch_dir(spark, "llm-tokens")
    write_tokens(docs, f"{root}/store", f"{root}/ids", public_tokenizers.path(TOKENIZER), END_ID)
    return read_tokens(spark, f"{root}/store")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_roundtrip(table(spark, sf_dir, "documents"))


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(fill_middle(table(spark, sf_dir, "documents"), seed=7, rate=100, spm_share=50))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction_audit(failed_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_mix_sources, op2_remove_repeats, op3_language, op4_simhash_near_dups, op5_quality_rules,
        op6_toxicity, op7_licenses, op8_token_store, op9_quality_scores, op10_decontaminate,
        op11_fill_middle, op12_filter_audit, op13_nearest_neighbours,
    )}


_OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (
  SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS k FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS m FROM x GROUP BY g),
c AS (
  SELECT DISTINCT doc_id, unnest(generate_series(k, k + 12)) AS p
  FROM x JOIN f USING (g) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS v, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT words.doc_id, count(c.p) AS gone,
         string_agg(v, ' ' ORDER BY words.p) FILTER (WHERE c.p IS NULL) AS rest
  FROM words LEFT JOIN c ON words.doc_id = c.doc_id AND words.p = c.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(gone, 0) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

_ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_OP10_SQL = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ALNUM} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT item, w, least(13, len(w)) AS n, unnest(generate_series(1, greatest(1, len(w) - 12))) AS k
        FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS k
        FROM d JOIN (SELECT DISTINCT n FROM iw) ON len(w) >= n)),
hits AS (SELECT doc_id, k, n, item FROM dw JOIN iw USING (g, n)),
cov AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN found USING (doc_id)"""


_OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid,
         array_to_string(u[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""


_OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
s AS (SELECT t, min(doc_id) AS least_id FROM d GROUP BY t),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         (len(w) < 200)::INT AS fa, (100 * len(list_distinct(w)) < 50 * len(w))::INT AS fb,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT AS fc,
         regexp_matches(t, '[#$%&*|]')::INT AS fd, coalesce(d.doc_id > least_id, false)::INT AS fe
  FROM d JOIN s USING (t) LEFT JOIN l ON d.doc_id = l.doc_id),
g AS (
  SELECT part, {'A': fa, 'B': fb, 'C': fc, 'D': fd, 'E': fe} AS x, count(*) AS n, sum(good) AS good, sum(bad) AS bad
  FROM f GROUP BY ALL),
g2 AS (
  SELECT part, n, good, bad, concat(CASE WHEN x.A = 1 THEN 'A' ELSE '' END, CASE WHEN x.B = 1 THEN 'B' ELSE '' END,
         CASE WHEN x.C = 1 THEN 'C' ELSE '' END, CASE WHEN x.D = 1 THEN 'D' ELSE '' END,
         CASE WHEN x.E = 1 THEN 'E' ELSE '' END) AS fails FROM g),
a AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (
  SELECT a1.c || a2.c || a3.c || a4.c || a5.c AS filter_order
  FROM a a1 JOIN a a2 ON a2.c <> a1.c JOIN a a3 ON a3.c NOT IN (a1.c, a2.c)
  JOIN a a4 ON a4.c NOT IN (a1.c, a2.c, a3.c) JOIN a a5 ON a5.c NOT IN (a1.c, a2.c, a3.c, a4.c)),
st AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
e AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS own, n, good, bad, fails,
         contains(fails, substr(filter_order, step, 1)) AS hit,
         translate(fails, substr(filter_order, 1, step - 1), '') <> fails AS earlier
  FROM g2 CROSS JOIN st),
r AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN NOT hit AND NOT earlier THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN hit AND NOT earlier THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN hit AND earlier THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN hit AND NOT earlier THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN hit AND NOT earlier THEN bad ELSE 0 END) AS toxic_lost
  FROM e GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r"""


def oracle() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op2_remove_repeats": _OP2_SQL, "op10_decontaminate": _OP10_SQL,
            "op11_fill_middle": _OP11_SQL, "op12_filter_audit": _OP12_SQL}
