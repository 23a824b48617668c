"""Structured Streaming form of the load."""
