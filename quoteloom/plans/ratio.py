"""Q7: daily ratio series from landed pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.dates import file_date
from quoteloom.operators.ratio import LOOKBACK, RATIO_PATTERN, latest_value, ratio_from_page, refresh
from quoteloom.schemas import RATIO_SERIES
from quoteloom.sinks.tables import write_series
from quoteloom.sources.files import read_table


def published_ratios(pages: DataFrame, pattern: str = RATIO_PATTERN) -> DataFrame:
    """(date, ratio) of pages whose address ends in the day they report."""
    return ratio_from_page(pages.withColumn("date", file_date(F.col("url"))), pattern).select("date", "ratio")


def run_ratio(spark: SparkSession, pages: DataFrame, path: str, today: date, lookback: int = LOOKBACK) -> DataFrame:
    """Fill the gap up to ``today`` and return the newest value."""
    known = read_table(spark, path, RATIO_SERIES)
    write_series(refresh(known, published_ratios(pages), today, lookback), path)
    return latest_value(read_table(spark, path, RATIO_SERIES))
