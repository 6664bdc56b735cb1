"""Operators that prepare training text: deduplication, filters, mixing, sharding, packing."""
