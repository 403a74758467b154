"""Spark-native single-cell RNA-seq analytics: DataFrame in, DataFrame out."""

__version__ = "0.1.0"
