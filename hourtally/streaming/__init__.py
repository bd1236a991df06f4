"""Structured Streaming jobs over the feeds."""
