"""Mixing sources to target weights: words per source, repetition rates, whole copies of documents.

Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the words of the whole table. A target
stops at three times its source's size; the excess goes to the others by weight until none is above. A document is
taken floor(rate) times and once more with probability equal to the fraction, drawn from a hash of its doc_id (of its
text where doc_id is null), so reruns agree.

Null text has no words; a source without words takes part with target 0; repeated rows are drawn alike; an empty table
gives an empty result. The table of sources stays a table: it is ranked by range partitions, its targets come from a
few small aggregates, and Spark broadcasts it only where its written size allows that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.llm.frames import every
from candlewick.sources.scratch import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and times its size that a source may give


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _ranked(totals: DataFrame) -> DataFrame:
    """`rank` from 0 in code-point order of the source, without sorting all sources in one task."""
    by_source = F.col("source").asc_nulls_last()
    sliced = totals.repartitionByRange(by_source).sortWithinPartitions(by_source)
    sliced = materialise(
        sliced.select("*", F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().alias("at")), "sources"
    )
    slices = sliced.groupBy("slice").agg(F.count("*").alias("n"), F.min("at").alias("begin"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = slices.select("slice", "begin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return sliced.join(offsets, "slice").withColumn("rank", F.col("offset") + F.col("at") - F.col("begin"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target of each source; `sizes` has source and size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("long")
    sources = materialise(_ranked(totals).select("source", "source_size", weight.alias("weight")), "source-weights")
    whole = lambda c: c.cast("decimal(38,0)")
    summed = sources.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    words, left, over = summed.words or 0, summed.words or 0, summed.weights or 1
    while True:  # once for each time that another target reaches its limit
        limit = MOST * F.col("source_size")
        above = whole(F.col("weight")) * F.lit(left).cast("decimal(19,0)") > whole(limit) * F.lit(over).cast("decimal(19,0)")
        reached = sources.agg(
            F.sum(F.when(above, limit)).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("weights")
        ).first()
        now = (words - (reached.full or 0), reached.weights or 1)
        if now == (left, over):
            break
        left, over = now
    share = (F.col("weight") * F.lit(left)).cast("double") / F.lit(over)
    return sources.select("source", "source_size", F.when(above, limit.cast("double")).otherwise(share).alias("target"))


def draw(doc_id: Column, text: Column, seed: str = "mix") -> Column:
    """A number from 0 up to 1, the same in every run."""
    key = F.coalesce(doc_id.cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(text, F.lit("")))))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 13)
    return F.conv(digits, 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def copies(size: Column, source_size: Column, target: Column, drawn: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return F.floor(rate) + F.when(drawn < rate - F.floor(rate), F.lit(1)).otherwise(F.lit(0))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes of the document, copies counted)."""
    drawn = draw(F.col("doc_id"), F.col("text")).alias("drawn")
    sizes = materialise(docs.select("doc_id", "source", n_words("text").alias("size"), drawn), "doc-sizes")
    plan = targets(sizes).withColumnRenamed("source", "of")
    times = copies(F.col("size"), F.col("source_size"), F.col("target"), F.col("drawn"))
    return sizes.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken")
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: rows of `docs` with all their columns, each as often as it is taken."""
    plan = targets(docs.select("source", n_words("text").alias("size")))
    plan = plan.select(*(F.col(c).alias(f"_mix_{c}") for c in plan.columns))
    times = copies(
        n_words(docs["text"]), F.col("_mix_source_size"), F.col("_mix_target"), draw(docs["doc_id"], docs["text"])
    )
    taken = docs.join(plan, docs["source"].eqNullSafe(F.col("_mix_source")))
    copy = F.explode(F.array_repeat(F.lit(0), times.cast("int"))).alias("_mix_copy")
    return taken.select(*every(docs), copy).drop("_mix_copy")
