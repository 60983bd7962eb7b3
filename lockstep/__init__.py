"""Spark-native alignment analytics for independently clocked recordings."""
