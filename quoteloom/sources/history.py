"""Stored bar history: the partitioned table, and folders of one CSV per symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.dates import stored_day, zone_suffix
from quoteloom.functions.text import blank_to_null, number, whole
from quoteloom.schemas import BARS, STATEMENTS
from quoteloom.sources.files import columns_of, field, read_csv, read_csv_folder, read_partitions, read_table


def read_bars(spark: SparkSession, path: str, interval: str | None = None) -> DataFrame:
    """Stored bars; with an interval, the partitions of other intervals are not even listed."""
    if interval is None:
        return read_table(spark, path, BARS)
    return read_partitions(spark, path, f"{path.rstrip('/')}/interval={interval}", BARS)


def read_history_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Per-symbol CSV files with mixed zone suffixes.

    The date is read as text and kept next to its calendar day (B5); the symbol is the file name.
    """
    raw, text = read_csv_folder(spark, folder), field
    return raw.select(
        F.regexp_replace("file_name", r"\.csv$", "").alias("symbol"),
        stored_day(text("Date")).alias("date"),
        text("Date").alias("date_text"),
        zone_suffix(text("Date")).alias("suffix"),
        number(text("Open")).alias("open"),
        number(text("High")).alias("high"),
        number(text("Low")).alias("low"),
        number(text("Close")).alias("close"),
        number(text("Adj Close")).alias("adj_close"),
        whole(text("Volume")).alias("volume"),
        F.col("row_order").alias("pos"),
    )


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """Landed statements in long form."""
    return read_table(spark, path, STATEMENTS)


def read_dated_folder(spark: SparkSession, folder: str) -> DataFrame:
    """M3: CSV files of one date each, all symbols in each, as long bars with ``pos``."""
    raw, text = read_csv_folder(spark, folder), field
    return raw.select(
        stored_day(text("Date")).alias("date"),
        blank_to_null(text("Symbol", "ticker")).alias("symbol"),
        *[number(text(n)).alias(n.lower()) for n in ("Open", "High", "Low", "Close")],
        number(text("Adj Close")).alias("adj_close"),
        whole(text("Volume")).alias("volume"),
        F.col("row_order").alias("pos"),
    )


def read_ratio_csv(spark: SparkSession, path: str) -> DataFrame:
    """M9: a ratio series kept as CSV, the date first and the ratio second."""
    day, value = columns_of(spark, path)[:2]
    return read_csv(spark, [path]).select(stored_day(field(day)).alias("date"), number(field(value)).alias("ratio"))


def read_rejects_csv(spark: SparkSession, path: str, source: str, interval: str | None = None) -> DataFrame:
    """Any of the three shapes of reject lists, ``Symbol, Date`` or ``ticker, error[, timeframe]``."""
    raw, text = read_csv(spark, [path]), field
    return raw.select(
        blank_to_null(text("Symbol", "ticker")).alias("symbol"),
        F.lit(source).alias("source"),
        F.coalesce(text("timeframe"), F.lit(interval)).alias("interval"),
        text("error").alias("reason"),
        stored_day(text("Date")).alias("first_seen"),
    )
