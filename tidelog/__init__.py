"""Spark-native ingest and event analytics: operators, sources, plans and streaming ingest."""
