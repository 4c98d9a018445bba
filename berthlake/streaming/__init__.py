"""Structured Streaming versions of ingest, change detection and upsert."""
