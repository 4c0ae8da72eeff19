"""Registered queries of the training-data operators; each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm import (align, decontaminate, edit_tokens, langid, lexical, mixing, multi_index, packing,
                        quality_bayes, risk_rules, sharding, simhash, warc)
from isobar.llm.common import read


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes over 4096 virtual slots."""
    return sharding.assign(read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document; the source is its host and the
    language section of that source its path."""
    return quality_bayes.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"),
                                  F.col("source"), F.col("lang"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.report(read(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    return warc.derivatives(read(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from every document."""
    return mixing.mix_report(read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    return risk_rules.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.packed(read(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return langid.report(read(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after two edits."""
    return edit_tokens.counts(read(spark, sf_dir, "documents"))


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    return multi_index.nearest(read(spark, sf_dir, "embeddings"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in windows of benchmark items."""
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizations of every document."""
    return align.report(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_token_counts": op9_token_counts,
    "op10_ann": op10_ann,
    "op11_decontamination": op11_decontamination,
    "op12_search": op12_search,
    "op13_alignment": op13_alignment,
}

_WORDS = r"[^\x20\x09-\x0D]+"
_FOLDED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {
    # measures, then the same steps, exact binomial sums and choice of a step
    "op6_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT *, regexp_extract_all(t, '{_WORDS}') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS lines
  FROM d
),
win AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 2)) AS i FROM w)
),
again AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
rep AS (
  SELECT rid, count(DISTINCT p) AS n
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY rid
),
m AS (
  SELECT w.rid, doc_id, lang, t, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep ON rep.rid = w.rid
),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
),
x AS (
  SELECT *, CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0.0 END AS x1,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS x2,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS x3,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS x4
  FROM b
),
v AS (
  SELECT *, (SELECT count(*) FROM range(0, {risk_rules.STEPS}) r(i)
             WHERE 1 - CAST(i + 1 AS DOUBLE) / {risk_rules.STEPS} >= greatest(x1, x2, x3)
               AND 24 - CAST(i AS DOUBLE) / 2 >= x4) AS step
  FROM x
),
lab AS (SELECT doc_id, bool_or(quality > 0) AS good FROM labels
        WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
held AS (
  SELECT lang, t, any_value(step) AS step, bool_or(good) AS good
  FROM v JOIN lab ON lab.doc_id = v.doc_id WHERE NOT base_failed GROUP BY lang, t
),
strata AS (SELECT lang, count(*) FILTER (WHERE good) AS n FROM held GROUP BY lang),
counts AS (
  SELECT s.lang, s.n, i, count(*) FILTER (WHERE good AND step <= i) AS lost,
         count(*) FILTER (WHERE NOT good AND step <= i) AS caught
  FROM (SELECT *, unnest(generate_series(0, {risk_rules.STEPS - 1})) AS i FROM strata) s
  JOIN held h ON h.lang IS NOT DISTINCT FROM s.lang
  GROUP BY ALL
),
safe AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY caught DESC, i) AS rk
  FROM counts
  WHERE n > 0 AND caught > 0 AND lost < n * {risk_rules.ALPHA}
    AND list_sum(list_transform(range(0, lost + 1), lambda j: exp(
          lgamma(n + 1.0) - lgamma(j + 1.0) - lgamma(n - j + 1.0)
          + j * ln({risk_rules.ALPHA}) + (n - j) * ln({1 - risk_rules.ALPHA}))))
        <= {risk_rules.DELTA} / (SELECT count(*) FROM strata)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (safe.i IS NULL OR step > safe.i) AS kept
FROM v LEFT JOIN safe ON safe.lang IS NOT DISTINCT FROM v.lang AND safe.rk = 1""",
    # all windows of every document against all windows of every item
    "op11_decontamination": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
),
b AS (
  SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
),
bn AS (SELECT item, w, least(len(w), {decontaminate.SPAN}) AS n FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM bn)
),
dw AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS x
  FROM (SELECT rid, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM bn) WHERE len(w) >= n)
),
hit AS (SELECT rid, i, dw.n, item FROM dw JOIN bw ON bw.n = dw.n AND bw.x = dw.x),
place AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(generate_series(i, i + n - 1)) AS p FROM (SELECT DISTINCT rid, i, n FROM hit))
  GROUP BY rid
),
named AS (
  SELECT rid, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
  FROM (SELECT DISTINCT rid, item FROM hit) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN place ON place.rid = d.rid LEFT JOIN named ON named.rid = d.rid""",
    # every document scored for every item
    "op12_search": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
),
t AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
q AS (
  SELECT row_number() OVER () AS qid, item_id,
         regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
),
qt AS (SELECT qid, item_id, term, count(*) AS c FROM (SELECT qid, item_id, unnest(w) AS term FROM q) GROUP BY ALL),
p AS (
  SELECT rid, doc_id, n, term, count(*) AS tf
  FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
s AS (
  SELECT qid, item_id, rid, doc_id,
         CAST(sum(c * CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
                  * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * nd) // l))))) AS BIGINT) AS score
  FROM qt JOIN p USING (term) JOIN df USING (term), t
  GROUP BY ALL
),
r AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id ASC NULLS LAST) AS rk
  FROM s WHERE score > 0
)
SELECT item_id, CAST(rk AS INTEGER) AS rank, doc_id, score FROM r WHERE rk <= {lexical.K}""",
}
