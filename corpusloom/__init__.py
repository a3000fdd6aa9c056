"""Spark-native analytics over curated document corpora."""

__version__ = "0.1.0"
