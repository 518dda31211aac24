"""Incremental staging feed on Structured Streaming."""
