"""Operators of a training-data pipeline: scoring, mixing, search, packing, filters, deduplication."""
