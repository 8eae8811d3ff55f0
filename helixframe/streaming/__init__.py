"""Structured Streaming jobs over the change log."""
