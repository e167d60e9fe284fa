"""Trailing averages kept up to date from a state per symbol (R3, R5), without reading history.

The state of a symbol is its last bars' running totals, in date order and as many as the longest span needs. The
average of the last n bars is the difference of two totals, so new bars need nothing else. A bar on or before the
newest date of its symbol is late: then the symbol's stored bars are read again and its totals begin anew; all other
symbols go on from their state.

A delivery is dealt and sorted by symbol once: totals, averages and the rows of the next state come from that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.functions.text import exact, exact_mean
from quoteloom.operators.trailing import one_bar_a_day
from quoteloom.session import stage

SPANS, VOLUME_SPAN = (50, 200), 10
_TOTALS = "date date, total decimal(34,8), count bigint, volume_total bigint, volume_count bigint"
STATE = f"symbol string, last array<struct<{', '.join(c.replace(' ', ':', 1) for c in _TOTALS.split(', '))}>>"


def _added(rows: DataFrame, also: list[str]) -> DataFrame:
    """Running totals by symbol: ``old`` rows have theirs, the others' values are added to the newest old ones."""
    upto = Window.partitionBy("symbol").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    close, volume = exact(F.col("close")), F.col("volume")
    new = lambda c: F.when(~F.col("old"), c)
    zero = lambda c: F.coalesce(c, F.lit(0))
    before = lambda c: zero(F.last(F.when(F.col("old"), F.col(c)), ignorenulls=True).over(upto))
    return rows.select(
        "symbol", "date", "close", "volume", *also,
        (before("total") + zero(F.sum(new(close)).over(upto))).cast("decimal(34,8)").alias("total"),
        (before("count") + F.count(new(close)).over(upto)).alias("count"),
        (before("volume_total") + zero(F.sum(new(volume)).over(upto))).alias("volume_total"),
        (before("volume_count") + F.count(new(volume)).over(upto)).alias("volume_count"),
    )


def advance(
    state: DataFrame, stored: DataFrame, delivered: DataFrame, spans: tuple[int, ...] = SPANS, volume_span: int = VOLUME_SPAN
) -> tuple[DataFrame, DataFrame]:
    """``(values, state)`` after a delivery: the averages that are new or changed, and the state for the next one.

    ``stored`` has the bars before this delivery, ``delivered`` the new ones (``symbol, date, close, volume``); a
    delivered bar replaces a stored one of its date. ``values`` has ``symbol, date, close, volume``, ``avg_<n>`` and
    ``avg_volume_<n>``; rows of their dates replace earlier ones. Rows without symbol or date are left out.
    """
    longest = max(*spans, volume_span)
    names = ["symbol", "date", "close", "volume"]
    fresh = one_bar_a_day(delivered).where("symbol IS NOT NULL AND date IS NOT NULL").select(*names)
    fresh = stage(fresh, "delivered")
    first = fresh.groupBy("symbol").agg(F.min("date").alias("since"))
    known = state.select("symbol", F.element_at("last", -1)["date"].alias("newest"))
    late = stage(first.join(known, "symbol").where("since <= newest").select("symbol", "since"), "late")

    totals = [c.split()[0] for c in _TOTALS.split(", ")]
    on_time = state.join(first, "symbol", "left_semi").join(late, "symbol", "left_anti")
    old = on_time.select("symbol", F.inline("last")).select("symbol", *totals, F.lit(True).alias("old"), F.lit(False).alias("shown"))
    rows = old.unionByName(fresh.withColumns({"old": F.lit(False), "shown": F.lit(True)}), allowMissingColumns=True)
    if not late.isEmpty():
        again = one_bar_a_day(stored).select(*names).join(late, "symbol").where("date IS NOT NULL")
        again = again.select(*names, F.lit(False).alias("old"), (F.col("date") >= F.col("since")).alias("shown"), F.lit(True).alias("stored"))
        rows = rows.withColumn("stored", F.lit(False)).unionByName(again, allowMissingColumns=True)
        # A stored bar stands before the delivered one of its date, which replaces it.
        turns = Window.partitionBy("symbol").orderBy("date", F.desc("stored"))
        rows = rows.withColumn("replaced", F.lead("date").over(turns).eqNullSafe(F.col("date"))).where("NOT replaced")

    order = Window.partitionBy("symbol").orderBy("date")
    since = lambda c, n: F.col(c) - F.coalesce(F.lag(c, n).over(order), F.lit(0))
    done = _added(rows, ["old", "shown"]).select(
        *names, "shown", *totals[1:],
        *[exact_mean(since("total", n), since("count", n)).alias(f"avg_{n}") for n in spans],
        exact_mean(since("volume_total", volume_span), since("volume_count", volume_span)).alias(f"avg_volume_{volume_span}"),
        F.lead("symbol", longest).over(order).isNull().alias("last"),
    )
    done = stage(done, "totals")
    values = done.where("shown").drop("shown", "last", *totals[1:])
    last = done.where("last").groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct(*totals))).alias("last"))
    kept = state.join(first, "symbol", "left_anti").select("symbol", "last").unionByName(last)
    return values, kept
