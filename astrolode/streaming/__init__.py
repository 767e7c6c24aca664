"""Structured Streaming twins of ingest and cleaning."""
