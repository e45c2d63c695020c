"""Incremental ingest, live state and live trends on Structured Streaming."""
