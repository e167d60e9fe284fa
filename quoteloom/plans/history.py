"""Q2: incremental history per symbol, with clean lists and rejects."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.dates import HISTORY_START
from quoteloom.operators.coverage import latest_dates, not_delivered
from quoteloom.operators.dedup import keep_last
from quoteloom.operators.info import with_attributes
from quoteloom.operators.merge import upsert_new_wins
from quoteloom.sinks.tables import as_bars, replace_dates_of, replace_rejects, replace_state, replace_table
from quoteloom.session import stage
from quoteloom.sources.files import exists, read_table
from quoteloom.sources.history import read_bars

LAST_DATES = "symbol string, last_date date"


def request_starts(symbols: DataFrame, last: DataFrame, interval: str, start: str | None = None) -> DataFrame:
    """First date wanted per symbol, from the newest stored dates (A3).

    Daily: the day after the newest stored bar. Weekly and monthly: the newest label itself, as that
    bar may still grow (B9). Symbols without history start at the interval's first date.
    """
    first = F.lit(start or HISTORY_START[interval]).cast("date")
    step = 1 if interval == "1d" else 0
    return symbols.select("symbol").join(last, "symbol", "left").select(
        "symbol", F.coalesce(F.date_add("last_date", step), first).alias("start")
    )


def known_dates(spark: SparkSession, stored: DataFrame, interval: str, state_path: str | None) -> DataFrame:
    """A3: newest stored date per symbol, from the kept state if there is one."""
    path = f"{state_path}/interval={interval}"
    if state_path is not None and exists(spark, path):
        return read_table(spark, path, LAST_DATES)
    return latest_dates(stored)


def wanted(landed: DataFrame, starts: DataFrame, end: date | str | None = None) -> DataFrame:
    """Landed bars of requested symbols from their own start on."""
    # The starts are hashed: landed rows are not sorted, and grouped where the join put them.
    rows = landed.join(starts.hint("shuffle_hash"), "symbol").filter(F.col("date") >= F.col("start"))
    if end is not None:
        rows = rows.filter(F.col("date") < F.lit(str(end)).cast("date"))
    return rows.drop("start")


def run_history(
    spark: SparkSession,
    symbols: DataFrame,
    landed: DataFrame,
    bars_path: str,
    interval: str,
    rejects_path: str,
    clean_path: str,
    today: date,
    order="pos",
    end: date | str | None = None,
    errors: DataFrame | None = None,
    state_path: str | None = None,
) -> DataFrame:
    """Merge landed bars into the stored ones; returns the written rows.

    Only the dates that are delivered are read back in full, and they are the ones replaced. The newest
    date of each symbol comes from ``state_path``, which each run extends; without it, or the first
    time, from one pass over the symbol column of the whole table. A state that lags behind after a
    failed run only asks for bars again that then win over themselves. A symbol counts as good when it
    has stored or new bars (``errors`` lists the others with their reason).
    """
    stored = read_bars(spark, bars_path, interval).filter(F.col("source") == "history")
    last = stage(known_dates(spark, stored, interval, state_path), "last")
    starts = request_starts(symbols, last, interval)
    new = keep_last(wanted(landed, starts, end), ["symbol", "date"], order)
    new = stage(as_bars(new.drop("pos"), interval, "history"), "new")
    dates = [r[0] for r in new.select("date").distinct().collect()]
    touched = stored.filter(F.col("date").isin(dates))
    new = new.select(*touched.columns)
    # Dates that are not stored yet need no merge; ``new`` is written already.
    merged = new if touched.isEmpty() else stage(upsert_new_wins(touched, new), "merged")
    good = stage(
        last.select("symbol").unionByName(new.select("symbol")).join(symbols.select("symbol"), "symbol", "left_semi").distinct(),
        "good",
    )
    replace_dates_of(merged, bars_path, interval, "history")
    replace_table(good, clean_path)
    if state_path is not None:
        newest = last.unionByName(latest_dates(new)).groupBy("symbol").agg(F.max("last_date").alias("last_date"))
        replace_state(newest, f"{state_path}/interval={interval}")
    bad = not_delivered(symbols.select("symbol"), good)
    reason = F.lit("no data")
    if errors is not None:
        bad = bad.join(errors.select("symbol", "reason"), "symbol", "left")
        reason = F.coalesce("reason", reason)
    replace_rejects(
        bad.select(
            "symbol", F.lit("history").alias("source"), F.lit(interval).alias("interval"),
            reason.alias("reason"), F.lit(str(today)).cast("date").alias("first_seen"),
        ),
        rejects_path, "history", interval,
    )
    return merged


def bars_with_attributes(bars: DataFrame, attributes: DataFrame) -> DataFrame:
    """M2: the wide form with the snapshot attributes on every bar, made on demand."""
    return with_attributes(bars, attributes)
