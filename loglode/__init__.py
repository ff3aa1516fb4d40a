"""Access-log analytics on Spark: ingest, enrich, filter, store and report."""
