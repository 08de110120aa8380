"""Operators of a training-data pipeline: duplicates, quality, toxicity, contamination, archives, mixing, shards."""
