"""Incremental ingest and windowed aggregates."""
