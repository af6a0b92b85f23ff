"""Spark-native retail and care-pathway analytics: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
