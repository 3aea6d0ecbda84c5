"""Spark-native corpus curation: text gates, adapters, dedup, mixing, chat rows, cards."""
