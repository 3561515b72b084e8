"""Structured Streaming jobs (incremental graph building)."""
