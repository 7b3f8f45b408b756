"""Spark-native entity resolution and data processing."""
