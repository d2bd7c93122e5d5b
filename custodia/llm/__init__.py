"""Operators for large text collections: deduplication, extraction, scoring, packing and encoding."""
