"""What is stored, what is behind, what is missing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_dates(bars: DataFrame) -> DataFrame:
    """A3: newest stored date per symbol."""
    return bars.groupBy("symbol").agg(F.max("date").alias("last_date"))


def staleness(symbols: DataFrame, bars: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Every symbol with its newest date and ``behind``/``current``; never stored is behind."""
    day = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    last = F.col("last_date")
    status = F.when(last.isNull() | (day > last), "behind").otherwise("current")
    return symbols.select("symbol").join(latest_dates(bars), "symbol", "left").withColumn("status", status)


def staleness_counts(report: DataFrame) -> DataFrame:
    """A4."""
    return report.agg(
        F.count_if(F.col("status") == "behind").alias("behind"),
        F.count_if(F.col("status") == "current").alias("current"),
    )


def written_counts(bars: DataFrame) -> DataFrame:
    """A2: distinct dates and symbols; Spark de-duplicates both on the map side first."""
    return bars.agg(
        F.countDistinct("date").alias("dates"), F.countDistinct("symbol").alias("symbols")
    )


def status_counts(df: DataFrame, status: Column) -> DataFrame:
    """One count per outcome."""
    return df.groupBy(status.alias("status")).agg(F.count("*").alias("rows"))


def not_delivered(requested: DataFrame, seen: DataFrame) -> DataFrame:
    """Requested symbols that are not in ``seen``."""
    return requested.join(seen.select("symbol"), "symbol", "left_anti")


def newly_rejected(requested: DataFrame, bars: DataFrame, today: date | str) -> DataFrame:
    """Requested symbols without a bar, stamped with ``today``.

    Daily bars decide when there are any, else all bars. When nothing at all was delivered, nobody is
    rejected (B4).
    """
    daily = bars.filter(F.col("interval") == "1d")
    seen = bars.filter((F.col("interval") == "1d") | ~daily.exists())
    missing = not_delivered(requested.select("symbol"), seen).filter(bars.exists())
    return missing.withColumn("first_seen", F.lit(str(today)).cast("date"))
