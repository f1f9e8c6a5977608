"""Structured Streaming forms of the capture."""
