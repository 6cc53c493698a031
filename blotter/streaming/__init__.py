"""Incremental feed ingest with Structured Streaming."""
