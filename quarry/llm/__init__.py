"""Operators for training-data pipelines: deduplication, filtering, search, formatting, mixing, packing, scoring."""
