"""Streaming device telemetry on Spark: topic to lake, metrics, series and checks."""
