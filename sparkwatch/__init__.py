"""Spark-native toolkit for building a surveillance warehouse from messy records and live text events."""

__version__ = "0.1.0"
