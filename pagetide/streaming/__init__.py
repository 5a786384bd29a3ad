"""Incremental loading with Structured Streaming."""
