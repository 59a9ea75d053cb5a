"""Operators for training-data pipelines: near-duplicates, mixing, scoring, formatting, search."""
