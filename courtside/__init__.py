"""Spark-native lineup-impact analytics."""
