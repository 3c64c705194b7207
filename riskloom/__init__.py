"""Spark-native transaction-risk analytics: DataFrame operators from raw tables to explained scores."""

__version__ = "0.1.0"
