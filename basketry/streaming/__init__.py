"""Incremental upserts and Structured Streaming jobs."""
