"""Spark-native record linkage and entity-resolution analytics."""
