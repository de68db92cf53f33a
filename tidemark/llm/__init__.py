"""Operators for training-data pipelines: scoring, deduplication, search, mixing and packing."""
