"""Spark-native event-panel analytics."""

__version__ = "0.1.0"
