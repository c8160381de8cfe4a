"""One query per operator over its whole table, and the SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings.llm import (
    conversation_repair, fingerprints, hamming_join, jaccard_join, licence_scan, mixing, piece_lattice, quality_classifier, quality_rules,
    source_divergence, suffix_dedup, token_codes, toxicity,
)
from postings.llm.shipping import ship
from postings.sources.warehouse import stored


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op3_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan(documents(spark, sf_dir)).select(
        "doc_id", F.size("sentence_ids").cast("long").alias("n_sentences"), F.array_join("sentence_ids", " ").alias("sentence_ids"),
        F.array_join("licences", " ").alias("licences"))


def op4_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = token_codes.encode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return token_codes.decode(stored(blocks))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(documents(spark, sf_dir), labels(spark, sf_dir))


def op7_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.summary(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("no_source", "source_key", "epochs")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(documents(spark, sf_dir))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(documents(spark, sf_dir))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(ship(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op13_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_join.join(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_quality_rules": op2_quality_rules,
    "op3_licence_scan": op3_licence_scan,
    "op4_token_codes": op4_token_codes,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_toxicity": op6_toxicity,
    "op7_piece_lattice": op7_piece_lattice,
    "op8_mixture": op8_mixture,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_fingerprints": op10_fingerprints,
    "op11_source_divergence": op11_source_divergence,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hamming_join": op13_hamming_join,
}

ORACLE = {
    "op3_licence_scan": licence_scan.oracle(),
    # The water level is found by trying every set of bounded sources in the order of bound per weight.
    "op8_mixture": r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS nosrc,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT src, nosrc, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY nosrc, src) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM d GROUP BY src, nosrc
), lines AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, nosrc, src) AS n FROM s
), cuts AS (
  SELECT a.n, 3 * (SELECT sum(source_size) FROM s)::BIGINT
              - 4 * coalesce((SELECT sum(source_size) FROM lines b WHERE b.n < a.n), 0)::BIGINT AS left2,
         (SELECT sum(weight) FROM lines b WHERE b.n >= a.n)::BIGINT AS open, weight, source_size
  FROM lines a
), level AS (
  SELECT left2, open FROM cuts WHERE weight * left2 < 4 * source_size * open ORDER BY n LIMIT 1
), t AS (
  SELECT src, nosrc, source_size,
         CASE WHEN weight * left2 >= 4 * source_size * open THEN (2 * source_size)::DOUBLE
              ELSE (weight * left2)::DOUBLE / (2 * open)::DOUBLE END AS target
  FROM s, level
), o AS (
  SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY nosrc, src ORDER BY md5(doc_id::VARCHAR), doc_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t USING (src, nosrc)
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM o
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(least(budget - epochs * source_size - before, size), 0))::BIGINT AS taken
FROM e
""",
    "op11_source_divergence": source_divergence.ORACLE,
    "op13_hamming_join": hamming_join.ORACLE,
}
