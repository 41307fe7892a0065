"""Structured Streaming forms of ingest."""
