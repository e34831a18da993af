"""Registered queries over the text operators, with production parameters and whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from replenish.llm import (
    alignment,
    bpe,
    exact_dedup,
    language,
    licenses,
    line_rules,
    mixing,
    near_dedup,
    quality,
    sharding,
    token_counts,
    url_filter,
    whitening,
)
from replenish.llm.common import documents

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.documents_digest(documents(spark, sf_dir), BYTE_BPE)


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.fit(docs))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.judged(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(documents(spark, sf_dir))


def op5_cleaned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.cleaned(documents(spark, sf_dir)).select("doc_id", "source", "text")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(documents(spark, sf_dir), near_dedup.Rule(words=3, percent=85))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(documents(spark, sf_dir))


def op8_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.noticed(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.written(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.documents_counts(documents(spark, sf_dir), PIECE_BPE)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.documents_digest(documents(spark, sf_dir), BYTE_BPE, PIECE_BPE)


URL_RULES = (
    url_filter.Rule("net/", url_filter.BLOCK),
    url_filter.Rule("example.net/en/", url_filter.ALLOW),
    url_filter.Rule("example.com/de/", url_filter.BLOCK),
    url_filter.Rule("org/fr/", url_filter.ALLOW),
)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_language": op2_language,
    "op3_mixing": op3_mixing,
    "op4_quality": op4_quality,
    "op5_line_rules": op5_line_rules,
    "op5_cleaned_lines": op5_cleaned_lines,
    "op6_near_dedup": op6_near_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_licenses": op8_licenses,
    "op8_license_notices": op8_license_notices,
    "op9_sharding": op9_sharding,
    "op10_token_counts": op10_token_counts,
    "op11_whitening": op11_whitening,
    "op12_alignment": op12_alignment,
    "op13_url_filter": op13_url_filter,
}

# DuckDB SQL for the same rows, where SQL can express them.

_EXACT_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), placed AS (
  SELECT doc_id, sha256(content) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM placed
"""

_LINE_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), lines AS (
  SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM docs
), normal AS (
  SELECT r, source, line, regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+') AS w FROM lines
), own AS (
  SELECT r, source, array_to_string(w, ' ') AS n, sum(len(w)) AS words FROM normal
  WHERE len(w) > 0 GROUP BY ALL
), shared AS (
  SELECT source, n FROM own GROUP BY source, n HAVING count(*) > 20
), removed AS (
  SELECT o.r, sum(o.words) AS words FROM own o
  JOIN shared s ON o.source IS NOT DISTINCT FROM s.source AND o.n = s.n GROUP BY o.r
), dups AS (
  SELECT r, count(*) - count(DISTINCT line) AS n FROM normal WHERE len(w) > 0 GROUP BY r
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), found AS (
  SELECT d.doc_id, len(w.w)::BIGINT AS n_words,
         length(regexp_replace(d.t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(d.t) - length(regexp_replace(d.t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(u.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(x.words, 0)::BIGINT AS removed_words
  FROM docs d JOIN words w USING (r) LEFT JOIN dups u USING (r)
  LEFT JOIN covered c USING (r) LEFT JOIN removed x USING (r)
), failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM found
)
SELECT *, NOT base_failed AND NOT (n_words - removed_words) * 100 <= n_words * 50 AS kept FROM failed
"""

# The texts that _LINE_RULES keeps, without the lines that it counts as removed.
_CLEANED_LINES = (
    _LINE_RULES.rstrip().rsplit("\n", 1)[0].replace("SELECT d.doc_id, len", "SELECT d.r, d.doc_id, d.source, len")
    + r"""
, numbered AS (
  SELECT r, source, unnest(string_split(t, chr(10))) AS line,
         generate_subscripts(string_split(t, chr(10)), 1) AS i FROM docs
), marked AS (
  SELECT *, array_to_string(regexp_extract_all(lower(line), '[^\x20\x09-\x0D]+'), ' ') AS n FROM numbered
), texts AS (
  SELECT m.r, string_agg(m.line, chr(10) ORDER BY m.i) AS text FROM marked m
  LEFT JOIN shared s ON m.source IS NOT DISTINCT FROM s.source AND m.n = s.n WHERE s.n IS NULL GROUP BY m.r
)
SELECT doc_id, source, text FROM failed JOIN texts USING (r)
WHERE NOT base_failed AND NOT (n_words - removed_words) * 100 <= n_words * 50
"""
)


def _mixing_sql() -> str:
    closing, last = "", "drawn"
    for turn in range(1, mixing.CLOSING + 1):
        closing += f"""
), gap{turn} AS (
  SELECT *, max(target) OVER p - sum(copies * size) OVER p AS gap FROM {last}
  WINDOW p AS (PARTITION BY place)
), best{turn} AS (
  SELECT r AS turned, CASE WHEN gap > 0 THEN 1 ELSE -1 END AS more FROM gap{turn}
  WHERE copies + CASE WHEN gap > 0 THEN 1 ELSE -1 END BETWEEN 0 AND 3
    AND abs(gap - CASE WHEN gap > 0 THEN size ELSE -size END) < abs(gap)
  QUALIFY row_number() OVER (PARTITION BY place
    ORDER BY abs(gap - CASE WHEN gap > 0 THEN size ELSE -size END), u, doc_id, text_key) = 1
), closed{turn} AS (
  SELECT {last}.* REPLACE (copies + coalesce(more, 0) AS copies)
  FROM {last} LEFT JOIN best{turn} ON r = turned"""
        last = f"closed{turn}"
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, md5(coalesce(text, '')) AS text_key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), sized AS (
  SELECT *, (length(bin(size)) - 1) // 4 AS class,
         (('0x' || substr(md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || text_key), 1, 12))::BIGINT
          + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM docs
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         row_number() OVER (ORDER BY source IS NULL, source) AS place FROM sized GROUP BY source
), weighed AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM sources
), stood AS (
  SELECT *, cap <= (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE
         / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) * weight AS capped
  FROM weighed
  WINDOW b AS (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT (sum(source_size) - coalesce(sum(cap) FILTER (capped), 0))::DOUBLE
         / sum(weight) FILTER (NOT capped) AS level FROM stood
), targets AS (
  SELECT source, place, source_size,
         CASE WHEN capped THEN cap::DOUBLE ELSE coalesce(level, 0) * weight END AS target FROM stood, level
), classes AS (
  SELECT place, class, any_value(target) AS target, sum(size)::BIGINT AS words, (1::BIGINT << class) AS pref
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source GROUP BY place, class
), levels AS (
  SELECT *, CASE WHEN sum(words * pref) OVER x > 0
    THEN (target - coalesce(sum(words) OVER y, 0)::DOUBLE * 3) / (sum(words * pref) OVER x)::DOUBLE ELSE 0 END AS lv
  FROM classes
  WINDOW x AS (PARTITION BY place ORDER BY class DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         y AS (PARTITION BY place ORDER BY class DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), expected AS (
  SELECT *, CASE WHEN lv * pref >= 3 THEN 3.0::DOUBLE ELSE
    least(arg_max(lv, class) FILTER (NOT lv * pref >= 3) OVER (PARTITION BY place) * pref, 3.0::DOUBLE) END AS e
  FROM levels
), parts AS (
  SELECT place, class, floor(e)::BIGINT AS certain, e - floor(e) AS chance,
         target - (sum(floor(e)::BIGINT * words) OVER (PARTITION BY place))::DOUBLE AS missing
  FROM expected
), offered AS (
  SELECT s.r, s.u, s.doc_id, s.text_key, s.size, t.place, t.source_size, t.target, p.certain, p.missing,
         p.chance, p.chance > 0 AND s.size > 0 AS chosen,
         CASE WHEN p.chance > 0 AND s.size > 0 THEN (s.u / (1 - s.u)) / (p.chance / (1 - p.chance)) END AS odds
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
  JOIN parts p ON p.place = t.place AND p.class = s.class
), drawn AS (
  SELECT *, certain + (chosen AND sum(size) OVER (PARTITION BY place, chosen
    ORDER BY odds, doc_id, text_key, r) <= missing)::BIGINT AS copies
  FROM offered{closing}
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM {last}
"""


def _licenses_sql() -> str:
    quote = lambda text: "'" + text.replace("'", "''") + "'"
    values = ", ".join(
        f"({i}, {quote(name)}, {quote(text)})" for i, (name, text) in enumerate(licenses.TEMPLATES)
    )
    pairs = (
        "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs"
    )
    words = r"list_filter(regexp_split_to_array(lower({}), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w"
    return f"""
WITH known AS (
  SELECT template, licence, {pairs} FROM (
    SELECT template, licence, {words.format("t")} FROM (VALUES {values}) v(template, licence, t))
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), units AS (
  SELECT r, unnest(string_split(t, chr(10))) AS unit, generate_subscripts(string_split(t, chr(10)), 1) AS line
  FROM docs UNION ALL SELECT r, t, 0 FROM docs
), paired AS (
  SELECT r, line, {pairs} FROM (SELECT r, line, {words.format("unit")} FROM units)
), met AS (
  SELECT r, line, template, licence, len(p.pairs) + len(k.pairs) AS total, len(list_intersect(p.pairs, k.pairs)) AS shared
  FROM paired p JOIN known k ON len(k.pairs) * {200 - licenses.PERCENT} >= len(p.pairs) * {licenses.PERCENT}
   AND len(k.pairs) * {licenses.PERCENT} <= len(p.pairs) * {200 - licenses.PERCENT}
), found AS (
  SELECT *, (2 * shared)::DOUBLE / total AS dice FROM met WHERE 200 * shared >= {licenses.PERCENT} * total
), best AS (
  SELECT r, count(DISTINCT line) AS n_units, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM found GROUP BY r
), first AS (
  SELECT r, licence, dice FROM found QUALIFY row_number() OVER (PARTITION BY r ORDER BY dice DESC, template) = 1
)
SELECT doc_id, licence, dice, coalesce(n_units, 0) AS n_units, coalesce(licences, '') AS licences
FROM docs LEFT JOIN best USING (r) LEFT JOIN first USING (r)
"""


_SHARDING = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15))::BIGINT AS h
  FROM documents
), levels AS (
  SELECT r, d::INT AS depth, h >> (60 - d)::INT AS prefix, bytes, h FROM docs, range(0, 61) t(d)
), buckets AS (
  SELECT depth, prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows,
         sum(bytes) <= {sharding.LIMIT_BYTES} OR min(h) = max(h) AS whole FROM levels GROUP BY ALL
), leaves AS (
  SELECT r, depth, prefix, shard_bytes, shard_rows FROM levels JOIN buckets USING (depth, prefix) WHERE whole
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY depth) = 1
)
SELECT doc_id, bytes, CASE WHEN depth = 0 THEN '' ELSE right(lpad(bin(prefix), 64, '0'), depth) END AS shard,
       CASE WHEN shard_bytes > {sharding.LIMIT_BYTES} AND shard_rows > 1
         THEN ((row_number() OVER (PARTITION BY h ORDER BY r) - 1) // greatest({sharding.LIMIT_BYTES} // bytes, 1))::BIGINT
         ELSE 0 END AS page,
       depth, shard_bytes, shard_rows
FROM docs JOIN leaves USING (r)
"""


SQL: dict[str, str] = {
    "op3_mixing": _mixing_sql(),
    "op5_line_rules": _LINE_RULES,
    "op5_cleaned_lines": _CLEANED_LINES,
    "op7_exact_dedup": _EXACT_DEDUP,
    "op8_licenses": _licenses_sql(),
    "op9_sharding": _SHARDING,
}
