"""Shards from a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations only.

The ring has 32,768 places. Every shard owns 64 virtual nodes at hashed places; a place belongs to the first node
clockwise. A row hashes to a place by its doc_id and text. Loads are bounded at the mean: a shard takes at most one
row more than any other, so counts differ by one at most (law `rows`). A place offers its rows to its owner first;
what a full shard refuses continues clockwise to the next shard with room. Another number of shards therefore moves
the new shard's rows and the overflow only.

Only the row count of each place reaches the driver (32,768 numbers, whatever the table), where the overflow is
walked; the answer is a table of ranges of positions within places, joined back by place. Equal rows are folded into
one with a count before anything is ordered, and unfolded in pieces at the end, so no key makes a task large.

Null doc_id and null text are values like any other (a null text has no bytes); repeated rows get a slot each; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlewick.sources.scratch import materialise

PLACES = 1 << 15
NODES = 64  # virtual nodes of a shard
REPEATS = 10_000  # of one row that a task writes
OVERHEAD = 16  # bytes a row takes besides its text


def ring(spark: SparkSession, shards: int, nodes: int = NODES) -> list[int]:
    """Owner of each place. Two nodes at one place: the smaller shard has it."""
    place = F.pmod(F.xxhash64(F.lit("node"), F.col("id")), F.lit(PLACES))
    found = spark.range(shards * nodes).select(place.alias("place"), F.floor(F.col("id") / nodes).cast("int").alias("shard"))
    owner: dict[int, int] = {}
    for row in found.collect():
        owner[row.place] = min(owner.get(row.place, shards), row.shard)
    taken = sorted(owner)
    return [owner[taken[bisect_left(taken, p) % len(taken)]] for p in range(PLACES)]


def bounded_loads(counts: dict[int, int], owner: list[int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges (place, from position, to position, shard, slot of the first) for the rows of each place."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    ranges: list[tuple[int, int, int, int, int]] = []

    def offer(place: int, begin: int, end: int, shard: int) -> int:
        taken = min(end - begin, room[shard])
        if taken:
            ranges.append((place, begin, begin + taken, shard, filled[shard]))
            room[shard] -= taken
            filled[shard] += taken
        return begin + taken

    refused = []
    for place in sorted(counts):
        begin = offer(place, 0, counts[place], owner[place])
        if begin < counts[place]:
            refused.append((place, begin, counts[place]))
    for place, begin, end in refused:
        step = place
        while begin < end:
            step = (step + 1) % PLACES
            begin = offer(place, begin, end, owner[step])
    return ranges


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; slots of a shard count from 0 without gaps."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    place = F.pmod(F.xxhash64(F.lit("row"), F.col("doc_id"), F.col("hash")), F.lit(PLACES))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    folded = materialise(
        rows.groupBy("doc_id", "size", "text_crc32", "hash").agg(F.count("*").alias("n")).withColumn("place", place),
        "shard-rows",
    )
    counts = {r.place: r.n for r in folded.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    found = bounded_loads(counts, ring(spark, shards), shards)
    plan = spark.createDataFrame(found, "place int, begin long, end long, shard int, base long")
    ordered = Window.partitionBy("place").orderBy("hash", F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    before = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    placed = folded.withColumn("first", F.coalesce(before, F.lit(0)))
    own = ["doc_id", "size", "text_crc32", F.col("place").cast("int").alias("place")]
    # a row that repeats more than REPEATS times is first cut into pieces, which are dealt to all tasks
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("n") - 1).cast("long"), F.lit(REPEATS).cast("long"))).alias("piece")
    many = placed.where(F.col("n") > REPEATS).select(*own, "first", "n", pieces)
    many = many.repartition("place", "doc_id", "piece").select(
        "doc_id",
        "size",
        "text_crc32",
        "place",
        (F.col("first") + F.col("piece")).alias("first"),
        F.least(F.lit(REPEATS), F.col("n") - F.col("piece")).cast("long").alias("n"),
    )
    pieced = placed.where(F.col("n") <= REPEATS).select(*own, "first", "n").unionByName(many)
    position = F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("position")
    each = pieced.select("doc_id", "size", "text_crc32", "place", position)
    # at most one row for each place and shard: bounded by the ring, not by the table
    return (
        each.join(F.broadcast(plan), "place")
        .where((F.col("position") >= F.col("begin")) & (F.col("position") < F.col("end")))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("base") + F.col("position") - F.col("begin")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
