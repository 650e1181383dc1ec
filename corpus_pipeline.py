"""The corpus pipeline: quality rules, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. `run` writes what a stage
returns as Parquet in the shared folder and reads it again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import bpe, mixing, quality, simhash
from candlewick.llm.queries import TOKENIZER, table
from candlewick.sources.scratch import discard, materialise, passing


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the classifier, which learns from those that `labels` judges."""
    return quality.kept_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id."""
    return simhash.first_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, ids (little-endian unsigned 32-bit), n_tokens, and whether decoding gives the text again."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), TOKENIZER)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "source", "ids", "n_tokens", exact.alias("exact"))


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_duplicates),
    ("mixing sources", mix_sources),
    ("bpe encoding", tokens),
]
ORACLE_SQL = None  # no SQL for hashes, merges and the classifier; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with passing(spark) as keep:  # what a stage wrote for itself goes, and what it read, once its result is there
            docs = keep(materialise(stage(spark, before, sf_dir), f"pipeline-{name.replace(' ', '-')}"))
        discard(before)
    return docs
