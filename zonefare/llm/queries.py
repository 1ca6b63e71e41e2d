"""Registered queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.llm import (bloom_lm, dual_tree, hard_negatives, hilbert, mixing, packing, pii, prefix_tokens, probminhash, quality_mcd, site_quality,
                          spelling, toxicity_chain)
from zonefare.llm.common import read_documents


def op1_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per copy of a document, in shuffled order."""
    docs = read_documents(spark, sf_dir).select("doc_id", "source", "text")
    out = mixing.poisson_replicate(docs, mixing.TARGET_WEIGHTS)
    return out.select("doc_id", "source", "mix_copies", "mix_copy", "mix_key")


def op2_robust_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    docs = read_documents(spark, sf_dir).select("doc_id", "lang", "source", "text")
    return quality_mcd.quality_verdicts(docs).drop("distance2")


def op3_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.find_personal_data(read_documents(spark, sf_dir).select("doc_id", "text"))


def op4_bloom_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document."""
    return bloom_lm.score_documents(read_documents(spark, sf_dir))


def op5_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document, from its prefix counts."""
    return prefix_tokens.count_tokens(read_documents(spark, sf_dir).select("doc_id", "text"))


def op6_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and verdict of every document."""
    return toxicity_chain.classify(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_dual_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every fiftieth vector."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return dual_tree.top_k(table, F.col("vec_id") % dual_tree.QUERY_EVERY == 0)


def op8_probminhash_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, and its class of equal texts."""
    docs = read_documents(spark, sf_dir).select("doc_id", "text")
    return probminhash.classes(docs).drop("text")


def op9_site_bayes_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality of every document; the source is its host, the language its section (path)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").cast("int"))
    return site_quality.judge(read_documents(spark, sf_dir), labels, F.col("source"), F.col("lang"))


def op10_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per piece of a document in the packed sequences."""
    return packing.pack(read_documents(spark, sf_dir))


def op11_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document along the Hilbert curve."""
    return hilbert.shard_documents(read_documents(spark, sf_dir))


def op12_reduced_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form and root of every word that occurs often enough."""
    return spelling.group_variants(read_documents(spark, sf_dir).select("doc_id", "text"))


def op13_l2ap_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return hard_negatives.query(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


_WEIGHTS_SQL = ", ".join(f"('{k}', {v})" for k, v in mixing.TARGET_WEIGHTS.items())

OP1_SQL = f"""
WITH target(component, weight) AS (VALUES {_WEIGHTS_SQL}),
docs AS (
  SELECT doc_id, source, text,
         CASE WHEN source IN (SELECT component FROM target WHERE component <> '*') THEN source ELSE '*' END AS component
  FROM documents),
sizes AS (SELECT component, sum(length(coalesce(text, '')) + 1) AS size FROM docs GROUP BY component),
present AS (SELECT s.component, s.size, t.weight FROM sizes s JOIN target t USING (component) WHERE t.weight > 0),
rates AS (
  SELECT component, weight / (SELECT sum(weight) FROM present) * (SELECT sum(size) FROM present) / size AS rate
  FROM present),
thresholds AS (
  SELECT component, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY component ORDER BY k) AS upto
  FROM rates, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS INTEGER))) AS k)),
hashed AS (
  SELECT doc_id, source, component,
         (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5)
           / 4503599627370496.0 AS u
  FROM docs),
counted AS (
  SELECT h.doc_id, h.source, CAST(count(t.k) AS INTEGER) AS mix_copies
  FROM hashed h LEFT JOIN thresholds t ON t.component = h.component AND t.upto <= h.u
  WHERE h.component IN (SELECT component FROM rates)
  GROUP BY h.doc_id, h.source)
SELECT doc_id, source, mix_copies, CAST(c AS INTEGER) AS mix_copy,
       CAST('0x' || substr(md5('17:order:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || c), 1, 15) AS BIGINT) AS mix_key
FROM counted, LATERAL (SELECT unnest(generate_series(0, mix_copies - 1)) AS c)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_poisson_mixing": op1_poisson_mixing,
    "op2_robust_quality": op2_robust_quality,
    "op3_weak_supervision_pii": op3_weak_supervision_pii,
    "op4_bloom_language_model": op4_bloom_language_model,
    "op5_prefix_token_counts": op5_prefix_token_counts,
    "op6_toxicity_chain": op6_toxicity_chain,
    "op7_dual_tree_top_k": op7_dual_tree_top_k,
    "op8_probminhash_classes": op8_probminhash_classes,
    "op9_site_bayes_quality": op9_site_bayes_quality,
    "op10_mixture_packing": op10_mixture_packing,
    "op11_hilbert_shards": op11_hilbert_shards,
    "op12_reduced_spelling": op12_reduced_spelling,
    "op13_l2ap_hard_negatives": op13_l2ap_hard_negatives,
}
ORACLE: dict[str, str] = {
    "op1_poisson_mixing": OP1_SQL,
    "op2_robust_quality": quality_mcd.oracle_sql(),
    "op7_dual_tree_top_k": dual_tree.ORACLE_SQL,
    "op11_hilbert_shards": hilbert.oracle_sql(),
    "op12_reduced_spelling": spelling.ORACLE_SQL,
    "op13_l2ap_hard_negatives": hard_negatives.ORACLE_SQL,
}
