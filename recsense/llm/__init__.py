"""Operators for large training corpora: search, mixing, packing, deduplication, counting, classification."""
