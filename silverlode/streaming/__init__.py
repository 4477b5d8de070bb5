"""Incremental facts as Structured Streaming queries."""
