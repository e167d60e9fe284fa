"""Bars as partial aggregates that merge (R1, R2, U1): late ticks join them without the ticks of before.

A partial bar keeps the order keys of its first and last tick. Merging is associative and commutative, so any split of
the ticks into deliveries and any order of them give the same bars, daily and over weeks or months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ("open", "open_key", "high", "low", "close", "close_key", "volume")


def partial_bars(ticks: DataFrame, keys: list[str], price: str, size: str, order: Column) -> DataFrame:
    """R1 with the keys of its ends: ``order`` ranks the ticks inside a key, see ``order_key``."""
    p = F.col(price)
    return ticks.groupBy(*keys).agg(
        F.min_by(p, order).alias("open"),
        F.min(order).alias("open_key"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, order).alias("close"),
        F.max(order).alias("close_key"),
        F.sum(size).cast("bigint").alias("volume"),
    )


def merge_partials(partials: DataFrame, keys: list[str]) -> DataFrame:
    """One partial bar per key from any number of them."""
    return partials.groupBy(*keys).agg(
        F.min_by("open", "open_key").alias("open"),
        F.min("open_key").alias("open_key"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_key").alias("close"),
        F.max("close_key").alias("close_key"),
        F.sum("volume").cast("bigint").alias("volume"),
    )


def by_label(partials: DataFrame, unit: str) -> DataFrame:
    """Daily partial bars as parts of weekly (Monday) or monthly (first day) ones; their keys rank days first."""
    if unit not in ("week", "month"):
        raise ValueError(f"unit must be week or month, not {unit!r}")
    ends = {c: F.struct(F.col("date").alias("day"), F.col(c).alias("key")) for c in ("open_key", "close_key")}
    return partials.withColumns(ends).withColumn("date", F.date_trunc(unit, F.col("date")).cast("date"))


def bars_of(partials: DataFrame) -> DataFrame:
    """The bars, without the keys of their ends."""
    return partials.drop("open_key", "close_key")
