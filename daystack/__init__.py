"""Spark-native engine for turning article directories into a clean daily series."""

__version__ = "0.1.0"
