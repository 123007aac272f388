"""Operators for preparing training data: filters, counts, near-duplicates, mixing and sharding."""
