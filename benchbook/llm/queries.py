"""Registered queries of this folder: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.llm import (
    brown, compression, crf, iblt, interaction, jaccard, mixing, packing, projections, reputation,
    rotation, secret_scan, token_counts,
)
from benchbook.llm.common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_versions(table(spark, sf_dir, "documents"))


@_query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = remainder("doc_id", 3) == 1
    model = compression.fit_quality(documents, labels, learn=~held_out)
    return compression.quality_report(documents, model, held_out)


@_query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 10) == 0
    found = brown.score_texts(documents, learn=~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score",
    )


#: Verdict and host/path of the fixed rules.
URL_RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
    ("allow", "org/fr/"),
]


@_query
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (table(spark, sf_dir, name) for name in ("pages", "labels"))
    outcomes = labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return reputation.judge_urls(pages, outcomes, URL_RULES)


CHECKS["op4_url_filters"] = reputation.check_sql(URL_RULES, most_bad=0.5)


@_query
def op6_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(table(spark, sf_dir, "documents"))


@_query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return packing.pack_documents(documents, public_tokenizers.path("word_bpe_49k.json"))


@_query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    held_out = remainder("doc_id", 5) == 0
    model = crf.fit_toxicity(documents, labels, learn=~held_out)
    return crf.toxicity_report(documents, model, held_out)


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.standard_mix(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "source", "lang", "tokens", "weight", "probability", "kept", "mix_error"
    )


@_query
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.near_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "kept")


@_query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotation.rearranged_digests(table(spark, sf_dir, "documents"))


CHECKS["op11_fill_in_middle"] = rotation.CHECK_SQL


@_query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return interaction.filter_audit(documents, labels)


CHECKS["op12_filter_audit"] = interaction.CHECK_SQL


@_query
def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return token_counts.token_report(documents, public_tokenizers.path("piece_bpe_32k.model"))


# SQL that compares all pairs: for the small tables, as a check of the results.
_REACHED = """reach AS (SELECT i, j FROM links UNION SELECT r.i, l.j FROM reach r JOIN links l ON r.j = l.i)"""

CHECKS["op7_embedding_near_dedup"] = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (
  SELECT vec_id, e, len(e) AS n FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS i, b.vec_id AS j FROM ok a JOIN ok b ON a.n = b.n AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
{_REACHED},
linked AS (SELECT i, count(*) AS n FROM links GROUP BY i),
lowest AS (SELECT i, min(j) AS low FROM reach GROUP BY i)
SELECT vec_id, coalesce(linked.n, 0)::BIGINT AS n_links,
  least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM v LEFT JOIN linked ON linked.i = vec_id LEFT JOIN lowest ON lowest.i = vec_id"""

CHECKS["op5_ngram_jaccard_join"] = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\\s+'), lambda x: x <> '')
    AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN ['']
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3),
      lambda i: array_to_string(words[i : i + 4], ' '))) END AS grams FROM w),
g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
links AS (
  SELECT a.doc_id AS i, b.doc_id AS j FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 10 * count(*) >= 8 * (a.n + b.n - count(*))),
{_REACHED},
linked AS (SELECT i, count(*) AS n FROM links GROUP BY i),
lowest AS (SELECT i, min(j) AS low FROM reach GROUP BY i)
SELECT doc_id, least(doc_id, coalesce(low, doc_id)) AS class_id,
  coalesce(linked.n, 0)::BIGINT AS n_links, doc_id = least(doc_id, coalesce(low, doc_id)) AS kept
FROM documents LEFT JOIN linked ON linked.i = doc_id LEFT JOIN lowest ON lowest.i = doc_id"""
