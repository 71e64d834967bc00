"""Structured Streaming forms of ingest, upsert and run status."""
