"""Spark-native text-corpus curation engine."""
