"""Spark-native engine for externally delivered data files."""

__version__ = "0.1.0"
