"""Messages in, tick log out, and the care of the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewick.adapters import AS_OF, encoded, messages, table, ticks
from candlewick.plans.staging import staged_ticks
from candlewick.queries.base import query, sql
from candlewick.queries.models import log_rows
from candlewick.schema import TICK_LOG
from candlewick.sources import log
from candlewick.sources import messages as wire
from candlewick.sources import tables
from candlewick.sources.scratch import new_folder

LOG_NUMBERS = "price volume bid ask"
_LOG_SQL = sql("SELECT * FROM log", "log", LOG_NUMBERS)


@query(
    "ingest_ticks",
    sql(
        """SELECT key, topic, partition, "offset", timestamp, time, symbol, price, volume, bid, ask, exchange,
                  "offset" * 1048576 + ('0x' || substr(md5(topic || '/' || partition), 1, 5))::BIGINT AS id,
                  timestamp AS inserted_at
           FROM messages WHERE NOT broken""",
        "messages",
        LOG_NUMBERS,
    ),
)
def ingest_ticks(spark, sf_dir):
    return wire.accepted(wire.parse_messages(messages(spark, sf_dir))).drop("value")


@query(
    "ingest_rejects",
    sql(
        """SELECT key, left(full_value, 20) AS value, topic, partition, "offset", timestamp,
                  'malformed json' AS problem FROM messages WHERE broken""",
        "messages",
    ),
)
def ingest_rejects(spark, sf_dir):
    """The dead-letter store, read back."""
    path = new_folder(spark, "rejects")
    wire.rejected(wire.parse_messages(messages(spark, sf_dir))).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "ingest_topics",
    sql(
        """SELECT topic, partition, count(*) AS messages, CAST(count_if(NOT broken) AS BIGINT) AS ticks,
                  CAST(count_if(broken) AS BIGINT) AS rejects,
                  min("offset") AS first_offset, max("offset") AS last_offset FROM messages GROUP BY ALL""",
        "messages",
    ),
)
def ingest_topics(spark, sf_dir):
    parsed = wire.parse_messages(messages(spark, sf_dir))
    return parsed.groupBy("topic", "partition").agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("problem").isNull()).alias("ticks"),
        F.count_if(F.col("problem").isNotNull()).alias("rejects"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


@query(
    "normalize_quotes",
    sql(
        "SELECT event_id, event_type AS symbol, ts AS time, CAST(value AS DOUBLE) AS price, 'USD' AS currency FROM events",
        ratios="price",
    ),
)
def normalize_quotes(spark, sf_dir):
    amount = F.struct(F.col("value").cast("string").alias("amount"), F.lit("USD").alias("currency"))
    payloads = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("time"),
        F.to_json(F.struct(amount.alias("data"))).alias("payload"),
    )
    return wire.normalise_quotes(payloads)


@query(
    "encode_messages",
    sql(
        """SELECT key, '{"symbol":"' || symbol || '","price":' || CAST(CAST(price AS DOUBLE) AS VARCHAR)
                  || ',"currency":"USD","timestamp":"' || strftime(time, '%Y-%m-%dT%H:%M:%S.%f')
                  || '","source":"spot","fetch_latency_ms":' || (id % 100) || '}' AS value FROM messages""",
        "messages",
    ),
)
def encode_messages(spark, sf_dir):
    return encoded(spark, sf_dir)


@query(
    "dedup_messages",
    sql('SELECT key, topic, partition, "offset", timestamp FROM messages', "messages"),
)
def dedup_messages(spark, sf_dir):
    """Everything delivered twice, as after a crash between write and commit."""
    once = messages(spark, sf_dir)
    again = once.withColumn("offset", F.col("offset") + F.lit(1_000_000_000))
    return wire.drop_redelivered(once.unionByName(again)).drop("value")


@query(
    "replay_from_offset",
    sql(
        """SELECT m.key, m.topic, m.partition, m."offset" FROM messages m
           JOIN (SELECT topic, partition, max("offset") // 2 AS pos FROM messages WHERE partition < 4 GROUP BY ALL) c
             ON m.topic = c.topic AND m.partition = c.partition WHERE m."offset" >= c.pos
           UNION ALL SELECT key, topic, partition, "offset" FROM messages WHERE partition >= 4""",
        "messages",
    ),
)
def replay_from_offset(spark, sf_dir):
    """Resume halfway; the last two partitions have no committed offset and start at the beginning."""
    source = messages(spark, sf_dir)
    committed = source.groupBy("topic", "partition").agg(F.expr("max(offset) div 2").alias("next_offset"))
    pending = wire.after_committed(source, committed.filter("partition < 4"))
    return pending.select("key", "topic", "partition", "offset")


@query("raw_log", _LOG_SQL)
def raw_log(spark, sf_dir):
    return log_rows(spark, sf_dir)


@query("append_log", sql("SELECT * FROM log UNION ALL SELECT * REPLACE (id + 1000000000 AS id) FROM log", "log", LOG_NUMBERS))
def append_log(spark, sf_dir):
    """Two appends, the second with new ids."""
    path, rows = new_folder(spark, "log"), log_rows(spark, sf_dir)
    log.append_log(rows, path)
    log.append_log(rows.withColumn("id", F.col("id") + 1_000_000_000), path)
    return log.read_log(spark, path).select(*TICK_LOG.names)


@query("clustered_log", sql("SELECT *, CAST(time AS DATE) AS dt FROM log", "log", LOG_NUMBERS))
def clustered_log(spark, sf_dir):
    path = new_folder(spark, "log")
    log.append_log(log_rows(spark, sf_dir), path)
    return log.read_log(spark, path)


@query("compact_log", _LOG_SQL)
def compact_log(spark, sf_dir):
    """Three appended pieces, then one rewrite of the old days."""
    path, rows = new_folder(spark, "log"), log_rows(spark, sf_dir)
    for part in range(3):
        log.append_log(rows.filter(F.pmod("id", F.lit(3)) == part), path)
    log.compact_log(spark, path, AS_OF)
    return log.read_log(spark, path).select(*TICK_LOG.names)


@query(
    "retention",
    sql("SELECT * FROM log WHERE CAST(time AS DATE) >= DATE '2024-01-31' - INTERVAL 20 DAYS", "log", LOG_NUMBERS),
)
def retention(spark, sf_dir):
    path = new_folder(spark, "log")
    log.append_log(log_rows(spark, sf_dir), path)
    log.expire_days(spark, path, AS_OF, keep_days=20)
    return log.read_log(spark, path).select(*TICK_LOG.names)


@query(
    "partition_inventory",
    sql(
        """SELECT CAST(time AS DATE) AS dt, min(time) AS range_start, max(time) AS range_end, count(*) AS row_count,
                  true AS has_files, CAST(time AS DATE) < DATE '2024-01-28' AS is_compacted FROM log GROUP BY ALL""",
        "log",
    ),
)
def partition_inventory(spark, sf_dir):
    path = new_folder(spark, "log")
    log.append_log(log_rows(spark, sf_dir), path)
    log.compact_log(spark, path, AS_OF)
    return log.day_inventory(spark, path).select(
        "dt",
        "range_start",
        "range_end",
        "row_count",
        ((F.col("file_count") > 0) & (F.col("total_bytes") > 0)).alias("has_files"),
        "is_compacted",
    )


@query("csv_source", sql("SELECT * FROM customer", numbers="c_acctbal"))
def csv_source(spark, sf_dir):
    """Out to CSV with a header, back in with declared types."""
    source, path = table(spark, sf_dir, "customer"), new_folder(spark, "csv")
    source.write.csv(path, header=True)
    return tables.read_csv(spark, path, source.schema)


@query(
    "json_report",
    sql("SELECT symbol, count(*) AS ticks, max(time) AS newest FROM stg GROUP BY 1", "stg"),
)
def json_report(spark, sf_dir):
    path = new_folder(spark, "report")
    report = (
        staged_ticks(ticks(spark, sf_dir)).groupBy("symbol").agg(F.count("*").alias("ticks"), F.max("time").alias("newest"))
    )
    tables.write_report(report, path)
    return spark.read.schema(report.schema).json(path)
