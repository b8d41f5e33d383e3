"""Spark-native curation analytics for large text-and-metadata corpora."""
