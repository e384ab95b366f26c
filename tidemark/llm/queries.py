"""Registered queries of this package, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm.decontaminate import overlaps
from tidemark.llm.filter_audit import audit
from tidemark.llm.id_files import round_trip
from tidemark.llm.jaccard_join import similar_documents
from tidemark.llm.language_id import identify
from tidemark.llm.lm_score import held_out_scores
from tidemark.llm.packing import pack
from tidemark.llm.periodic_runs import run_report
from tidemark.llm.quality import judged
from tidemark.llm.sanitise import report
from tidemark.llm.suffix_dedup import repeated_spans
from tidemark.llm.text import documents
from tidemark.llm.toxicity import toxicity
from tidemark.llm.vptree import nearest


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(documents(spark, sf_dir)).drop("spans")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return held_out_scores(documents(spark, sf_dir))


def op5_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(documents(spark, sf_dir))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_language_id": op3_language_id,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_token_id_files": op5_token_id_files,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_pii": op10_pii,
    "op11_filter_audit": op11_filter_audit,
    "op12_toxicity": op12_toxicity,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

#: DuckDB twins of the queries that SQL can express on whole tables. The others hold trained
#: models, byte-pair ids, digests of cut texts or approximate search; their tests compare them
#: with brute force, the library, or held-out labels.
ORACLE: dict[str, str] = {
    "op7_ngram_jaccard_join": r"""WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM texts WHERE len(w) > 0
), grams AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM places
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS MATERIALIZED (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT x, b FROM reached JOIN links ON y = a
)
SELECT x AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y) AS component_id
FROM reached LEFT JOIN sizes ON x = sizes.doc_id GROUP BY x""",
    "op11_filter_audit": r"""WITH labelled AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS copy
  FROM documents
), masks AS (
  SELECT part, CAST(len(w) < 200 AS INT)
         + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS INT)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(copy AS INT) AS mask,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM texts LEFT JOIN labelled USING (doc_id)
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good,
         count(*) FILTER (toxic) AS toxic
  FROM masks GROUP BY part, mask
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS own,
         CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INT) AS gone
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), applied AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (mask & (gone | own) = 0) AS kept,
         sum(n) FILTER (mask & own > 0 AND mask & gone = 0) AS removed,
         sum(n) FILTER (mask & own > 0 AND mask & gone > 0) AS redundant,
         sum(n) FILTER (mask = own) AS unique_fails,
         sum(good) FILTER (mask & own > 0 AND mask & gone = 0) AS good_lost,
         sum(toxic) FILTER (mask & own > 0 AND mask & gone = 0) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
       CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
       CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
       CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS BIGINT) AS shapley
FROM applied""",
}
