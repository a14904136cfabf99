"""Spark-native dataset curation: deduplication, scoring, routing and index upkeep."""
