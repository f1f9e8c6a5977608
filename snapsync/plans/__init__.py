"""Composite plans: change reads, pulls, polls."""
