"""Merging new rows into stored ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.dates import DEFAULT_SUFFIX, with_suffix, zone_suffix

BAR_KEY = ["symbol", "date"]


def upsert_new_wins(old: DataFrame, new: DataFrame, keys: list[str] = BAR_KEY) -> DataFrame:
    """Stored rows whose key is not delivered again, and all delivered rows.

    Only the keys of ``new`` reach the join. When they measure small Spark broadcasts them and the
    stored side streams through without a shuffle. ``new`` has one row per key.
    """
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_only(old: DataFrame, new: DataFrame, keys: list[str] = BAR_KEY) -> DataFrame:
    """The rows of ``new`` whose key is not stored yet."""
    return new.join(old.select(*keys), keys, "left_anti")


def upsert_old_wins(old: DataFrame, new: DataFrame, keys: list[str] = BAR_KEY) -> DataFrame:
    """Stored rows stay as they are, missing keys are added."""
    return old.unionByName(insert_only(old, new, keys))


def add_rejects(old: DataFrame, new: DataFrame, keys: list[str] = ["symbol"]) -> DataFrame:
    """U4: union of both lists, the first date seen per symbol."""
    return old.unionByName(new).groupBy(*keys).agg(F.min("first_seen").alias("first_seen"))


def union_wide(frames: list[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ; absent values are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def last_suffix(stored: DataFrame, text: str = "date_text", pos: str = "pos") -> DataFrame:
    """Zone suffix of the last stored row per symbol, a default where that row has none."""
    suffix = F.coalesce(zone_suffix(F.col(text)), F.lit(DEFAULT_SUFFIX))
    return stored.groupBy("symbol").agg(F.max_by(suffix, pos).alias("suffix"))


def restore_suffix(new: DataFrame, suffixes: DataFrame) -> DataFrame:
    """stored form of the date of each new row; symbols never stored get the default suffix."""
    joined = new.join(suffixes, "symbol", "left")
    suffix = F.coalesce(F.col("suffix"), F.lit(DEFAULT_SUFFIX))
    return joined.withColumn("date_text", with_suffix(F.col("date"), suffix)).drop("suffix")
