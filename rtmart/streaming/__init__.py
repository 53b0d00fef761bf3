"""Structured Streaming jobs built from the same functions as the batch queries."""
