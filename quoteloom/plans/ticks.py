"""Bars kept from deliveries of ticks.

Each delivery leaves its partial bars, one partition for each date and delivery, so running a delivery again replaces
what it left and counts nothing twice. Readers merge the partials of a key; old ticks are never read.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.operators.partials import bars_of, by_label, merge_partials, partial_bars
from quoteloom.sources.files import read_table

PARTIALS = (
    "symbol string, open double, open_key decimal(38,0), high double, low double, close double, close_key decimal(38,0), "
    "volume bigint, date date, delivery string"
)


def run_ticks(ticks: DataFrame, path: str, delivery: str, price: str, size: str, order: Column) -> None:
    """Adds one delivery of ticks (``symbol``, ``date``, price, size); the same name replaces its former rows by date.

    ``order`` ranks all ticks of a symbol and day, over all deliveries.
    """
    fresh = partial_bars(ticks, ["symbol", "date"], price, size, order.cast("decimal(38,0)"))
    rows = fresh.withColumn("delivery", F.lit(delivery)).hint("rebalance", F.col("date"))
    rows.write.partitionBy("date", "delivery").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def read_tick_bars(spark: SparkSession, path: str, unit: str = "day", start: date | None = None, end: date | None = None) -> DataFrame:
    """Daily, weekly or monthly bars of all deliveries, of ``start <= date < end``; only those dates are read."""
    partials = read_table(spark, path, PARTIALS)
    if start is not None:
        partials = partials.where(F.col("date") >= F.lit(start))
    if end is not None:
        partials = partials.where(F.col("date") < F.lit(end))
    if unit != "day":
        partials = by_label(partials, unit)
    return bars_of(merge_partials(partials, ["symbol", "date"]))
