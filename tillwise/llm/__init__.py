"""Operators for preparing training data: search, encoding, extraction, packing, mixing, scoring, deduplication."""
