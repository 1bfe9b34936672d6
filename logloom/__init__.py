"""Spark-native log collection and record processing."""
