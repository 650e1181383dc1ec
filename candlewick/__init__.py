"""Price-tick analytics on Spark: ingest, models, streaming, data quality and table operators."""
