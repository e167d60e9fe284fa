"""Structured Streaming form of the bulk merge."""
