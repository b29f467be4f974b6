"""Operators for training-data pipelines: dedup, sharding, tokens, search, classifiers, packing."""
