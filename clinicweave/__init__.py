"""Spark-native analytics engine: facility register tagging and validation."""
