"""Incremental file ingest and streaming silver (Structured Streaming)."""
