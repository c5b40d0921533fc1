"""Spark-native analytics for product-specification evidence tables."""
