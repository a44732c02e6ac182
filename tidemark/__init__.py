"""Spark-native extraction and change capture."""
