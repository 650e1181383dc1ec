"""One query for each operator over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from candlewick.llm import bpe, forest, lm, minhash, mixing, periodic, quality, records, sharding, simhash, token_counts, warc, whitening

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers of a session that was started elsewhere look for this package here
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.maintained(table(spark, sf_dir, "documents"), TOKENIZER, "byte_bpe_50k", restored=True)


def op4_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.detect(table(spark, sf_dir, "documents"), periodic.planted))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_bpe,
        op3_token_counts,
        op4_token_records,
        op5_warc,
        op6_mixing,
        op7_nearest,
        op8_lm_scores,
        op9_shards,
        op10_quality,
        op11_periodic_runs,
        op12_minhash,
        op13_whitening,
    )
}

# Sources in the order of (3 x size / weight) reach their limit one after the other, so the targets have a closed form.
MIXING = r"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS key
    FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
    SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight FROM sizes),
steps AS (
    SELECT *, row_number() OVER w AS step, sum(3 * source_size) OVER w AS full_before, sum(weight) OVER w AS weight_before,
           sum(source_size) OVER () AS words, sum(weight) OVER () AS weights
    FROM weighed WINDOW w AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST)),
shares AS (
    SELECT *, words - (full_before - 3 * source_size) AS left_words,
           weights - (weight_before - weight) AS left_weight
    FROM steps),
cut AS (
    SELECT left_words, left_weight FROM shares
    WHERE weight::HUGEINT * left_words <= 3::HUGEINT * source_size * left_weight ORDER BY step LIMIT 1),
targets AS (
    SELECT source, source_size,
           CASE WHEN weight::HUGEINT * left_words > 3::HUGEINT * source_size * left_weight THEN (3 * source_size)::DOUBLE
                ELSE (weight * left_words)::DOUBLE / left_weight::DOUBLE END AS target
    FROM weighed, cut),
rates AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           ('0x' || substr(md5('mix:' || key), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS drawn
    FROM docs JOIN targets ON docs.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rates
"""

ORACLES: dict[str, str] = {"op6_mixing": MIXING}
