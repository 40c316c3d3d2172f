"""Spark-native curation engine for conversational training data."""

__version__ = "0.1.0"
