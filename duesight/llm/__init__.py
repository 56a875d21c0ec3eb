"""Operators for training-data pipelines: search, cleaning, deduplication, packing, encoding."""
