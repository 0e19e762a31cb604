"""Incremental triggering of the daily run with Structured Streaming."""
