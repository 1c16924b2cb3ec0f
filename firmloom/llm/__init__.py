"""Operators for training-data pipelines: cleaning, deduplication, scoring, search and packing."""
