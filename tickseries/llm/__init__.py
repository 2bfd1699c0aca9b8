"""Operators for training-data pipelines: deduplication, scoring, tokens, archives."""
