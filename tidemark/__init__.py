"""Spark-native analytics for append-only observation histories."""
