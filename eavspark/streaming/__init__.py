"""Incremental upkeep of a value store with Structured Streaming."""
