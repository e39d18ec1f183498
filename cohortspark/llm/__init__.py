"""Operators for preparing training text: sharding, mixing, encoding, screening, deduplication, search."""
