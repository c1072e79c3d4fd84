"""Queries op1 to op13 over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_codec, conversations, decontaminate, html_extract, jaccard_join, katz, language_id, quality_rules, suffix_dedup, token_counts, token_output, toxicity, whitening


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, repetition and symbols of each document, the base rules and the verdict with its host's."""
    found = quality_rules.judged(documents(spark, sf_dir), ["doc_id"], host="source", max_host_rate=0.5)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP1_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         row_number() OVER () AS rid
  FROM documents
), g AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) > 2)
), r AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1
), c AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM r, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), m AS (
  SELECT doc_id, source, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (rid)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
), h AS (
  SELECT source, count(*) AS n, count(*) FILTER (WHERE base_failed) AS k FROM b WHERE source IS NOT NULL GROUP BY source
), p AS (
  SELECT coalesce(sum(k) / sum(n), 0.0) AS mean, coalesce(var_samp(k / n), 0.0) AS v FROM h
), q AS (
  SELECT mean, CASE WHEN v > 0 THEN least(1e6, greatest(1.0, mean * (1 - mean) / v - 1)) ELSE 1e6 END AS weight FROM p
), s AS (
  SELECT source, (k + mean * weight) / (n + weight) > 0.5 AS host_failed FROM h, q
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_failed, false) AS kept
FROM b LEFT JOIN s USING (source)
"""


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shingle count and the component of each document."""
    return jaccard_join.linked(documents(spark, sf_dir))


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (g) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2
  ) JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)
), r AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION
  SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(min(r.other), w.doc_id) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, n.n
"""


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document, those that lie in repeated strings, and what remains."""
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of each document; documents that are held out are never learnt from."""
    docs = documents(spark, sf_dir)
    found = language_id.with_language(docs, docs, keep=["doc_id"])
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_pretokens and n_tokens under the public piece vocabulary."""
    return token_counts.with_token_counts(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"), keep=["doc_id"])


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, severity (expected grade), grade and toxic.

    Grades of labelled documents: 0 not toxic, 1 toxic, 2 toxic and of low quality.
    """
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic is not null")
    grade = F.when(F.col("toxic") == 0, 0).otherwise(1 + F.coalesce((F.col("quality") == 0).cast("int"), F.lit(0)))
    model = toxicity.fitted(labels.select("doc_id", grade.alias("grade")), docs)
    return toxicity.with_severity(docs, model, keep=["doc_id"])


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of all documents as Simple-8b blocks, read them back, and describe each document's ids."""
    return token_output.token_ids(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=2)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, words hit by benchmark windows and the items that hit, for each document."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.with_contamination(documents(spark, sf_dir), benchmark, window=13, keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP9_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), bw AS (
  SELECT DISTINCT item, k, array_to_string(ws[i : i + k - 1], ' ') AS gram
  FROM (SELECT item, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)
), dw AS (
  SELECT rid, i, k, array_to_string(ws[i : i + k - 1], ' ') AS gram
  FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k)
), h AS (
  SELECT DISTINCT rid, i, k, item FROM dw JOIN bw USING (k, gram)
), c AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM h) GROUP BY rid
), o AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM h WHERE item IS NOT NULL) GROUP BY rid
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(o.n, 0) AS BIGINT) AS n_items, sha256(coalesce(o.s, '')) AS items_sha256,
       coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN o USING (rid)
"""


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents by the rank file, and the bytes decoded from them, as digests."""
    return bpe_codec.encoded_digests(documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the first 32 components of the covariance of all of them, a row for each component."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found = whitening.whitened(rows, components=32, keep=["vec_id"])
    each = found.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "value"))
    explained = F.get("explained", F.col("place"))
    return each.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("value").alias("whitened"), explained.alias("explained"), "identity_error")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of each damaged conversation, and its cheapest repair."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conversations.repaired(conversations.damaged(rows), rows)


def op13_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and backoff log10 probability of each whole text; held-out documents are never learnt from."""
    docs = documents(spark, sf_dir)
    held = katz.held_out(F.col("doc_id"))
    found = katz.scored(docs.select("doc_id", "text", held.alias("held_out")), ~held, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_jaccard_join, op3_suffix_dedup, op4_language_id, op5_token_counts, op6_toxicity, op7_html_extraction, op8_token_output, op9_decontamination, op10_bpe_codec, op11_whitening, op12_conversation_repair, op13_katz_scores)
}
ORACLES = {"op1_quality_rules": OP1_SQL, "op2_jaccard_join": OP2_SQL, "op9_decontamination": OP9_SQL}
