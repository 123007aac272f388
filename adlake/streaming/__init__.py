"""Structured Streaming forms of the idempotent ingest and the keyed upsert."""
