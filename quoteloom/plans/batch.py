"""Q1: landed batch bars to date partitions, and the symbols that delivered nothing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.dates import resolve_range
from quoteloom.operators.bars import drop_without_close, select_dates
from quoteloom.operators.coverage import newly_rejected
from quoteloom.operators.merge import add_rejects
from quoteloom.operators.universe import clean_batch_symbols, restrict
from quoteloom.sinks.tables import replace_dates_by_first, replace_state
from quoteloom.session import stage
from quoteloom.sources.files import read_table

BATCH_REJECTS = "symbol string, first_seen date"


def requested_symbols(raw_list: DataFrame, rejects: DataFrame | None) -> DataFrame:
    """(symbol, pos), cleaned, once each, without the known rejects."""
    return clean_batch_symbols(raw_list.select("symbol", "pos"), "pos", rejects)


def run_batch(
    spark: SparkSession,
    landed: dict[str, DataFrame],
    raw_list: DataFrame,
    bars_path: str,
    rejects_path: str,
    today: date,
    order="pos",
    ranges: dict[str, tuple] | None = None,
    use_rejects: bool = True,
) -> dict[str, DataFrame]:
    """Write the first bar of each requested symbol and date per interval, and extend the reject list.

    Returns the distinct counts per interval.

    ``landed`` maps interval to long bars; ``ranges`` maps interval to (start, end, period). Rows go straight to their
    dates, which are then replaced as a whole.
    """
    known = read_table(spark, rejects_path, BATCH_REJECTS)
    symbols = stage(requested_symbols(raw_list, known if use_rejects else None), "symbols")
    seen, counts = [], {}
    for interval, rows in landed.items():
        start, end, period = (ranges or {}).get(interval, (None, None, "max"))
        start, end = resolve_range(start, end, today)
        rows = drop_without_close(select_dates(rows, start, end, period, today))
        delivered = stage(restrict(rows.select("symbol").distinct(), symbols), "delivered")
        dates = replace_dates_by_first(restrict(rows, symbols), bars_path, interval, "batch", order, sizes=rows)
        counts[interval] = delivered.agg(F.lit(dates).cast("bigint").alias("dates"), F.count("symbol").alias("symbols"))
        seen.append(delivered.withColumn("interval", F.lit(interval)))
    delivered = seen[0]
    for more in seen[1:]:
        delivered = delivered.unionByName(more)
    new = newly_rejected(symbols, delivered, today)
    replace_state(add_rejects(known, new.select("symbol", F.col("first_seen"))), rejects_path)
    return counts
