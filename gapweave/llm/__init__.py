"""Operators for training-data corpora: scans, deduplication, filters and packing."""
