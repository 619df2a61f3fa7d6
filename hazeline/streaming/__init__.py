"""Structured Streaming forms of the ingest and roll-up jobs."""
