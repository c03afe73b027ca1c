"""Incremental extraction with Structured Streaming."""
