"""Streaming commerce analytics as Spark DataFrame operators."""
