"""The operators' queries over the whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html, jaccard, licenses, media, mixing, packing, quality, sharding, substring, toxicity
from .license_texts import ALL
from .text import WORD

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.links_and_groups(table(spark, sf_dir, "documents"), n=4, percent=85)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = mixing.rates(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rated.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), templates=ALL)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


OP3_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM d),
win AS (SELECT rid, s, array_to_string(ws[s:s + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS u(s)),
twice AS (SELECT rid, s FROM win QUALIFY count(*) OVER (PARTITION BY rid, k) > 1),
cover AS (SELECT rid, count(DISTINCT p) AS n FROM twice, unnest(range(s, s + 8)) AS u(p) GROUP BY rid),
f AS (SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(ls) AS n_lines,
             length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AS letters, length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS capitals,
             len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS lettered
      FROM w LEFT JOIN cover USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR NOT word_chars BETWEEN 2 * n_words AND 14 * n_words
            OR 2 * n_dup_lines > n_lines OR 2 * capitals > letters OR 4 * lettered < 3 * n_words) AS kept
FROM b
"""

OP4_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
             ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS gs FROM d),
s AS (SELECT md5(array_to_string(list_sort(gs), chr(10))) AS node, min(doc_id) AS doc_id, any_value(gs) AS gs FROM g WHERE len(gs) > 0 GROUP BY 1),
x AS (SELECT doc_id, len(gs) AS n, unnest(gs) AS gram FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k, any_value(a.n) + any_value(b.n) AS n
           FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM common WHERE 185 * k >= 85 * n),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach(a, b) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
root AS (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY 1)
SELECT g.doc_id, len(g.gs) AS n_shingles, coalesce(root, g.doc_id) AS component_id
FROM g LEFT JOIN s ON s.node = md5(array_to_string(list_sort(g.gs), chr(10))) AND len(g.gs) > 0 LEFT JOIN root ON root.doc_id = s.doc_id
"""

OP5_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(ws[s:s + 19], ' ')) AS k FROM d, unnest(range(1, len(ws) - 18)) AS u(s)),
late AS (SELECT doc_id, s FROM win QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, s) > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM late, unnest(range(s, s + 20)) AS u(p) GROUP BY doc_id),
word AS (SELECT doc_id, i, ws[i] AS w FROM d, unnest(range(1, len(ws) + 1)) AS u(i)),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS t FROM word ANTI JOIN (SELECT doc_id, unnest(ps) AS i FROM gone) AS g USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1]::BIGINT AS weight FROM s),
c AS (SELECT *, 2 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS all_size, sum(weight) OVER ()::BIGINT AS all_weight,
             sum(2 * source_size) OVER o::BIGINT AS cap_so_far, sum(weight) OVER o::BIGINT AS weight_so_far FROM r
      WINDOW o AS (ORDER BY 2 * source_size / weight::DOUBLE, 2 * source_size, weight RANGE UNBOUNDED PRECEDING)),
f AS (SELECT *, 2 * cap * (all_weight - (weight_so_far - weight)) <= weight * (3 * all_size - 2 * (cap_so_far - cap)) AS is_full FROM c),
g AS (SELECT *, coalesce(sum(cap) FILTER (is_full) OVER (), 0)::BIGINT AS cap_full, coalesce(sum(weight) FILTER (is_full) OVER (), 0)::BIGINT AS weight_full FROM f),
t AS (SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE
             ELSE (weight * (3 * all_size - 2 * cap_full))::DOUBLE / (2 * (all_weight - weight_full))::DOUBLE END AS target FROM g),
e AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS coin
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (coin < rate - floor(rate))::INT))::BIGINT AS taken FROM e
"""

QUERIES = {
    "op1_media_columns": op1_media_columns,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_quality_rules": op3_quality_rules,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_html_extraction": op6_html_extraction,
    "op7_mixing": op7_mixing,
    "op8_license_scans": op8_license_scans,
    "op9_toxicity": op9_toxicity,
    "op10_sharding": op10_sharding,
}

ORACLE_SQL = {"op3_quality_rules": OP3_SQL, "op4_ngram_jaccard": OP4_SQL, "op5_substring_dedup": OP5_SQL, "op7_mixing": OP7_SQL}
