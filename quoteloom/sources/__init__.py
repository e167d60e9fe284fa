"""Readers of landed files and stored tables."""
