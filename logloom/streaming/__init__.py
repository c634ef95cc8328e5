"""Structured Streaming forms of ingest, consume, search and collect."""
