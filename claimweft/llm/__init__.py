"""Operators for training-data corpora: filtering, deduplication, search, formatting, mixing, sharding."""
