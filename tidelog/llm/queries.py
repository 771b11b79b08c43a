"""The queries that apply each operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bytebpe, embeddings, htmlcrf, mixing, ngramtrie, pii, quality, simhash, tokenfile, toxicity
from .common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmlcrf.extract(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_files(table(spark, sf_dir, "documents"))


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.byte_bpe(table(spark, sf_dir, "documents"))


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.session_key(spark)).select("doc_id", "n_entities", "text")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramtrie.lm_scores(table(spark, sf_dir, "documents"), order=3)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CAST([5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS BIGINT) AS weight, 3 * source_size AS cap FROM sources),
levels AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS left_size, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS left_weight
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (SELECT *, cap * left_weight > weight * left_size AS open FROM levels),
targets AS (
  SELECT source, source_size, CASE WHEN open THEN CAST(CAST(weight * (SELECT first(left_size ORDER BY cap / weight, source NULLS LAST) FROM opened WHERE open) AS BIGINT) AS DOUBLE)
    / CAST((SELECT first(left_weight ORDER BY cap / weight, source NULLS LAST) FROM opened WHERE open) AS DOUBLE) ELSE CAST(cap AS DOUBLE) END AS target FROM opened),
plans AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS n_full, CAST(floor(target + 0.5) AS BIGINT) AS budget FROM targets),
runs AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.n_full, p.budget - p.n_full * p.source_size AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, CAST(n_full * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken FROM runs
"""

OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT v.vec_id, CAST(coalesce(d.n, 0) AS BIGINT) AS n_links, least(v.vec_id, coalesce(l.b, v.vec_id)) AS component_id,
       v.vec_id <= coalesce(l.b, v.vec_id) AS kept
FROM v LEFT JOIN degree d ON v.vec_id = d.a LEFT JOIN low l ON v.vec_id = l.a
"""


def _op9_sql() -> str:
    """The rules over exact words, lines and n-grams; thresholds come from the operator."""
    lengths = (quality.WINDOW, *quality.NGRAM_LIMITS)
    grams = ", ".join(
        f"CASE WHEN p + {n} - 1 <= n THEN string_agg(w, ' ') OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) END AS g{n}" for n in lengths
    )
    twice = ", ".join(f"g{n} IS NOT NULL AND count(*) OVER (PARTITION BY rid, g{n}) > 1 AS t{n}" for n in lengths)
    inside = ", ".join(f"bool_or(t{n}) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"coalesce(sum(length(w)) FILTER (c{n}), 0) AS m{n}" for n in quality.NGRAM_LIMITS)
    shares = ", ".join(f"coalesce(m{n}, 0)::DOUBLE / greatest(coalesce(word_chars, 0), 1)::DOUBLE AS dup_{n}gram_share" for n in quality.NGRAM_LIMITS)
    over = " OR ".join(f"dup_{n}gram_share > {x}::DOUBLE" for n, x in quality.NGRAM_LIMITS.items())
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (SELECT rid, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM split),
grams AS (SELECT rid, w, p, {grams} FROM words),
twice AS (SELECT rid, w, p, {twice} FROM grams),
inside AS (SELECT rid, w, {inside} FROM twice),
per AS (SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (c{quality.WINDOW}) AS n_repeat_words, {sums} FROM inside GROUP BY rid),
lines AS (SELECT rid, l, row_number() OVER (PARTITION BY rid, l) > 1 AS later
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
by_line AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (later) AS dups, sum(length(l)) AS chars, coalesce(sum(length(l)) FILTER (later), 0) AS dup_chars FROM lines GROUP BY rid),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(dups, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(dups, 0)::DOUBLE / greatest(coalesce(n_lines, 0), 1)::DOUBLE AS dup_line_share, coalesce(dup_chars, 0)::DOUBLE / greatest(coalesce(chars, 0), 1)::DOUBLE AS dup_line_char_share, {shares}
  FROM d LEFT JOIN per USING (rid) LEFT JOIN by_line USING (rid)),
judged AS (SELECT *, n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > {quality.MOST_REPEAT} * n_words AS base_failed FROM measured)
SELECT *, NOT (base_failed OR dup_line_share > {quality.LINE_LIMIT}::DOUBLE OR dup_line_char_share > {quality.LINE_CHAR_LIMIT}::DOUBLE
  OR n_symbols::DOUBLE > {quality.SYMBOL_LIMIT}::DOUBLE * n_words::DOUBLE OR {over}) AS kept FROM judged
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_mix_sources": OP2_SQL, "op5_embedding_near_dedup": OP5_SQL, "op9_quality_rules": _op9_sql()}
