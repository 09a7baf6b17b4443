"""Spark-native analytics for coding-agent session logs."""
