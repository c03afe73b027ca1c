"""Whole queries: the graph's read API, extraction end to end, ingestion."""
