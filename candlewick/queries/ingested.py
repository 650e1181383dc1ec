"""Models over ticks that went through ingest: messages -> append -> log -> model."""

from __future__ import annotations

from candlewick.adapters import AS_OF, SPAN, messages
from candlewick.plans import alerts, candles, monitor
from candlewick.plans.staging import staged_ticks
from candlewick.queries.base import CANDLE_NUMBERS, PARTS, query, sql
from candlewick.queries.models import ALERT_NUMBERS, ALERTS
from candlewick.queries.monitoring import WRITE_THROUGHPUT
from candlewick.sources import log
from candlewick.sources import messages as wire
from candlewick.sources.scratch import new_folder


def ingested(spark, sf_dir):
    """The log that parsed messages make, read back."""
    path = new_folder(spark, "ingested")
    log.append_log(log.to_log_rows(wire.accepted(wire.parse_messages(messages(spark, sf_dir)))), path)
    return log.read_log(spark, path)


@query("ingested_candles", sql(PARTS["candles"].replace("FROM stg", "FROM ingested"), "ingested", CANDLE_NUMBERS))
def ingested_candles(spark, sf_dir):
    return candles.candles(staged_ticks(ingested(spark, sf_dir)))


@query("ingested_alerts", sql(ALERTS.replace("FROM stg", "FROM ingested"), "ingested", ALERT_NUMBERS))
def ingested_alerts(spark, sf_dir):
    return alerts.price_alerts(staged_ticks(ingested(spark, sf_dir)))


@query("ingested_throughput", sql(WRITE_THROUGHPUT.replace("FROM log", "FROM ingested"), "ingested"))
def ingested_throughput(spark, sf_dir):
    return monitor.write_throughput(ingested(spark, sf_dir), SPAN, AS_OF)
