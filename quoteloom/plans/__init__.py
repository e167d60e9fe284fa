"""Whole jobs: read, combine operators, write. The current day is always an argument."""
