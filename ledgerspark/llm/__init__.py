"""Operators for preparing training data: dedup, scoring, packing, search."""
