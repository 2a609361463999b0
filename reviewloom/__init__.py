"""Spark-native analytics over customer reviews: ingest, validate, extract reasons, report."""
