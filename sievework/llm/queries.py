"""The registered queries of the subpackage, each over its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import (
    attention_lm,
    collocations,
    exact_dedup,
    hard_negatives,
    mixing,
    packing,
    robust_outliers,
    rule_quality,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
)
from sievework.llm.common import documents


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; SIEVEWORK_TOKENIZERS names another folder."""
    if folder := os.environ.get("SIEVEWORK_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = robust_outliers.judged(documents(spark, sf_dir), keep=["doc_id"])
    statistics = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("row.doc_id", *statistics, "base_failed", "kept", "distance")


def op3_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeat_report(documents(spark, sf_dir))


def op4_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = rule_quality.quality(documents(spark, sf_dir), labels, keep=["doc_id"])
    return scored.select("row.doc_id", "held_out", "score", "predicted")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.mix(documents(spark, sf_dir), ["doc_id"])
    return chosen.select("row.doc_id", "size", "source_size", "target", "taken")


def op6_packed_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op7_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_lm.score_texts(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.tiktoken"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.toxicity(documents(spark, sf_dir), labels)


def op10_top_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0)


def op11_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return exact_dedup.exact_duplicates(docs, exact_dedup.earlier_half(docs))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, moved)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
        op1_simhash_groups,
        op2_robust_outliers,
        op3_repeated_spans,
        op4_rule_quality,
        op5_token_counts,
        op6_packed_bins,
        op7_attention_scores,
        op8_toxicity,
        op9_source_mix,
        op10_top_vectors,
        op11_exact_duplicates,
        op12_hard_negatives,
        op13_collocations,
    )}

ORACLES = {
    "op9_source_mix": r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS source, source IS NULL AS absent,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(concat('mix:', coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))) AS key
  FROM documents),
totals AS (SELECT absent, source, sum(size)::BIGINT AS source_size FROM base GROUP BY ALL),
weighed AS (
  SELECT *, source_size * 2.0::DOUBLE AS most,
         CASE (row_number() OVER (ORDER BY absent, source) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM totals),
placed AS (
  SELECT *, most / weight AS full_at, row_number() OVER (ORDER BY most / weight, absent, source) AS place,
         sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget FROM weighed),
levels AS (
  SELECT *, (budget - coalesce(sum(most) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM placed),
cut AS (SELECT min(full_at) AS open_at, arg_min(level, place) AS level FROM levels WHERE level * weight <= most),
targets AS (
  SELECT l.absent, l.source, l.source_size,
         CASE WHEN c.open_at IS NULL OR l.full_at < c.open_at THEN l.most ELSE c.level * l.weight END AS target
  FROM levels l, cut c),
ordered AS (
  SELECT b.doc_id, b.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS whole,
         (sum(b.size) OVER (PARTITION BY b.absent, b.source ORDER BY b.key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS until
  FROM base b JOIN targets t ON b.absent = t.absent AND b.source = t.source),
rests AS (SELECT *, floor(target - whole * source_size + 0.5)::BIGINT AS rest FROM ordered)
SELECT doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, rest - (until - size))))::BIGINT AS taken
FROM rests""",
    "op10_top_vectors": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
  FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 5""",
    "op11_exact_duplicates": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)""",
    "op12_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.e, c.e)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
   AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT * FROM ranked WHERE rank <= 10""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM lists GROUP BY lang),
starts AS (SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM lists WHERE len(w) > 0),
counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*)::HUGEINT AS f
  FROM starts, (VALUES (1), (2), (3), (4), (5)) AS lengths(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
stay AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts p
  WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM counts q WHERE q.lang = p.lang AND q.k > p.k AND 100 * q.f >= 100 * p.f
     AND contains(concat(' ', q.phrase, ' '), concat(' ', p.phrase, ' ')))),
cuts AS (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM stay),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000""",
}
