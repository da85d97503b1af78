"""Spark-native engine for curating streams of text content."""

__version__ = "0.1.0"
