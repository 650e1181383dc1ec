"""Structured Streaming forms of the ingest, the candles and the alerts."""
