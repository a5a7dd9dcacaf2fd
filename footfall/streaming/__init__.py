"""Structured Streaming versions of the ingest jobs."""
