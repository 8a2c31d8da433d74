"""Spark-first document corpus engine."""
