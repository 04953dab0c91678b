"""Spark-native analytics over service telemetry."""
