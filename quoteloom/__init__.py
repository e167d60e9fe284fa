"""Spark-native preparation of market data: symbols, bars, fundamentals, ratio series."""

__version__ = "0.1.0"
