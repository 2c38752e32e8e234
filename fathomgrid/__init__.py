"""Spark-native analytics over exported workplace data."""

__version__ = "0.1.0"
