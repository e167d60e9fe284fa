"""Q3, Q11: bulk snapshot files into the stored history; stored bars win."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.dates import file_date
from quoteloom.operators.coverage import not_delivered, status_counts
from quoteloom.operators.merge import insert_only
from quoteloom.operators.universe import restrict
from quoteloom.session import stage
from quoteloom.sinks.tables import append_bars, as_bars, replace_rejects
from quoteloom.sources.bulk import dated_files, last_written, read_bulk, read_bulk_folder
from quoteloom.sources.files import name_of
from quoteloom.sources.history import read_bars
from quoteloom.sources.ledger import landed_files, pending, record


def merge_bulk(rows: DataFrame, stored: DataFrame, symbols: DataFrame | None) -> DataFrame:
    """The bars to add: of requested symbols, one per (symbol, date), not stored yet.

    Rows of other symbols go before anything is grouped; only symbol and date of ``stored`` are read.
    """
    return insert_only(stored, delivered_bars(rows, symbols))


def delivered_bars(rows: DataFrame, symbols: DataFrame | None) -> DataFrame:
    return last_written(rows if symbols is None else restrict(rows, symbols))


def run_bulk(
    spark: SparkSession,
    paths: list[str],
    symbols: DataFrame | None,
    bars_path: str,
    interval: str = "1d",
    rejects_path: str | None = None,
) -> DataFrame:
    """Merge the given files, see :func:`merge_rows`."""
    return merge_rows(spark, read_bulk(spark, paths), symbols, bars_path, interval, rejects_path)


def merge_rows(
    spark: SparkSession,
    rows: DataFrame,
    symbols: DataFrame | None,
    bars_path: str,
    interval: str = "1d",
    rejects_path: str | None = None,
) -> DataFrame:
    """Merge the valid rows of some files; returns the counts of added and already stored bars.

    The dates are known from the files, so the stored table is read for those partitions only. A late
    file is merged like any other (T2). With ``rejects_path`` the requested symbols that the files have
    no valid row for replace the bulk reject list of the interval (K8).
    """
    delivered = stage(delivered_bars(rows, symbols), "delivered")
    dates = [r[0] for r in delivered.select("date").distinct().collect()]
    stored = read_bars(spark, bars_path, interval).filter(F.col("date").isin(dates))
    known = stored.select("symbol", "date").withColumn("_known", F.lit(True)).distinct()
    flagged = stage(delivered.join(known, ["symbol", "date"], "left"), "flagged")
    added = flagged.filter(F.col("_known").isNull()).drop("_known")
    counts = stage(
        status_counts(flagged, F.when(F.col("_known").isNull(), "added").otherwise("already stored")), "counts"
    )
    append_bars(as_bars(added, interval, "bulk"), bars_path)
    if rejects_path is not None and symbols is not None:
        replace_rejects(
            not_delivered(symbols.select("symbol"), delivered).select(
                "symbol", F.lit("bulk").alias("source"), F.lit(interval).alias("interval"),
                F.lit("no valid row").alias("reason"), F.lit(max(dates, default=None)).cast("date").alias("first_seen"),
            ),
            rejects_path, "bulk", interval,
        )
    return counts


def run_latest_bulk(
    spark: SparkSession, folder: str, symbols, bars_path: str, interval: str = "1d", rejects_path: str | None = None
) -> DataFrame | None:
    """Q3: all files of the newest date in the folder; None when there is none."""
    newest = dated_files(spark, folder).agg(F.max("file_date")).first()[0]
    if newest is None:
        return None
    rows = read_bulk_folder(spark, folder, day=newest)
    return merge_rows(spark, rows, symbols, bars_path, interval, rejects_path)


def run_backfill(
    spark: SparkSession, folder: str, symbols, bars_path: str, interval: str = "1d", ledger_path: str | None = None
) -> DataFrame | None:
    """Q11: every dated file of the folder in one scan; bars have their own dates, so no order is needed.

    With a ledger only files that are new or changed since the runs before are read; None when there is none. A
    ledger belongs to one store and one set of symbols.
    """
    if ledger_path is None:
        if dated_files(spark, folder).isEmpty():
            return None
        return merge_rows(spark, read_bulk_folder(spark, folder), symbols, bars_path, interval)
    files = landed_files(spark, folder)
    found = pending(spark, files.where(file_date(name_of(F.col("path"))).isNotNull()), ledger_path)
    if found is None:
        return None
    changed, where, only = found
    counts = merge_rows(spark, read_bulk_folder(spark, folder, where, only), symbols, bars_path, interval)
    record(changed, ledger_path)
    return counts
