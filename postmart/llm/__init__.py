"""Operators of a training-data pipeline: packing, filters, extraction, deduplication, archives."""
