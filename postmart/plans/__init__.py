"""Whole jobs (full load, transform only, ingest only) built from the operators."""
