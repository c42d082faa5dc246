"""Spark-native engine for map-route analytics over nested DataFrame columns."""
