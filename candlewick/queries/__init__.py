"""Registered queries over the driver's tables, each with the SQL it is checked against where SQL can say it."""

from candlewick.queries import extras, ingest, ingested, models, monitoring, operators, quality, reports, streams
from candlewick.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "extras", "ingest", "ingested", "models", "monitoring", "operators", "quality", "reports", "streams"]
