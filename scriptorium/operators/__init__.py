"""Spark-native operators over long-form corpus tables."""
