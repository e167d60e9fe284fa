"""Trailing values per symbol.

Input is one bar per (symbol, date), as made by ``bars_from_ticks``, so a symbol has at most one row
per calendar day and a window group is bounded by the length of the calendar, not by the ticks. Bars with a column
``source``, as ``read_bars`` gives them, may have one bar a day for each source; the first source counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quoteloom.functions.text import exact, exact_mean
from quoteloom.operators.dedup import keep_first


# Which source's bar stands for a day; others come behind these, by name.
SOURCES = ("history", "bulk", "batch")


def one_bar_a_day(bars: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """One bar per symbol and day (and interval) over several sources; bars without a source column stay as they are."""
    if "source" not in bars.columns:
        return bars
    keys = [c for c in ("interval", "symbol", "date") if c in bars.columns]
    place = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    order = [F.when(place > 0, place).otherwise(len(sources) + 1).alias("place"), F.coalesce("source", F.lit("")).alias("source")]
    return keep_first(bars, keys, order)


def _by_date() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def _running() -> WindowSpec:
    return _by_date().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _trailing(total: str, n: int) -> Column:
    """Sum or count of the last n rows as a difference of running totals: constant work per row for any n."""
    return F.col(total) - F.coalesce(F.lag(total, n).over(_by_date()), F.lit(0))


def _averages(bars: DataFrame, value: Column, column: str, spans: dict[str, int]) -> DataFrame:
    """Mean of the values among the last n bars; bars without a value count for nothing, none at all give NULL."""
    staged = bars.select(
        "symbol", "date", column,
        F.coalesce(F.sum(value).over(_running()), F.lit(0)).alias("_total"),
        F.count(value).over(_running()).alias("_count"),
    )
    averages = [exact_mean(_trailing("_total", n), _trailing("_count", n)).alias(name) for name, n in spans.items()]
    return staged.select("symbol", "date", column, *averages)


def moving_averages(bars: DataFrame, spans: tuple[int, ...] = (50, 200), column: str = "close") -> DataFrame:
    """Average close of the last n bars (fewer at the start), from exact sums.

    NULL, NaN and infinite prices are missing values.
    """
    return _averages(one_bar_a_day(bars), exact(F.col(column)), column, {f"avg_{n}": n for n in spans})


def average_volume(bars: DataFrame, n: int = 10) -> DataFrame:
    """Average volume of the last n bars, of those that have one."""
    return _averages(one_bar_a_day(bars), F.col("volume"), "volume", {f"avg_volume_{n}": n})


def high_low(bars: DataFrame, days: int = 365) -> DataFrame:
    """Highest high and lowest low of the last ``days`` calendar days, the current one included.

    The calendar is cut into blocks of ``days`` days. A bar's span is the head of its own block up to the bar and the
    tail of the block before, from the bar's place on: running extrema forwards in one and backwards in the other.
    Each bar takes part twice, once as an own bar and once as a bar of the block before, so the work does not depend
    on the length of the span.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    number = F.unix_date("date")
    block = F.floor(number / F.lit(days)).cast("long")
    roles = F.array(*[F.struct((block + k).alias("_block"), F.lit(k == 0).alias("_own")) for k in (0, 1)])
    twice = one_bar_a_day(bars).select("symbol", "date", "high", "low", F.pmod(number, F.lit(days)).alias("_place"), F.inline(roles))
    together = Window.partitionBy("symbol", "_block")
    head = together.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # From the last place down; an own bar goes before an earlier one of its place, which is out of its span.
    tail = together.orderBy(F.desc("_place"), F.desc("_own")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = lambda c: F.when(F.col("_own"), F.col(c))
    past = lambda c: F.when(~F.col("_own"), F.col(c))
    ends = twice.select(
        "symbol", "date", "_own",
        F.greatest(F.max(own("high")).over(head), F.max(past("high")).over(tail)).alias("high_52w"),
        F.least(F.min(own("low")).over(head), F.min(past("low")).over(tail)).alias("low_52w"),
    )
    return ends.where("_own").drop("_own")


def trading_snapshot(bars: DataFrame) -> DataFrame:
    """R3-R5 at the newest bar of each symbol, without computing them for every bar.

    The averages are conditional sums over the ranks of dates.
    """
    newest_first = Window.partitionBy("symbol").orderBy(F.desc("date"))
    # The newest 365 different dates hold the last 365 days; Spark cuts the rest before the shuffle.
    ranked = one_bar_a_day(bars).select(
        "symbol", "date", "high", "low", "close", "volume", F.dense_rank().over(newest_first).alias("_rank")
    ).filter("_rank <= 365")
    # A second window after the cut, over rows that are already sorted.
    ranked = ranked.withColumn("_last", F.first("date").over(newest_first))
    rank = F.col("_rank")

    def mean(value: Column, n: int) -> Column:
        kept = F.when(rank <= n, value)
        return exact_mean(F.sum(kept), F.count(kept))

    in_year = F.col("date") > F.date_sub("_last", 365)
    return ranked.groupBy("symbol").agg(
        F.max("_last").alias("date"),
        mean(exact(F.col("close")), 50).alias("fiftyDayAverage"),
        mean(exact(F.col("close")), 200).alias("twoHundredDayAverage"),
        F.max(F.when(in_year, F.col("high"))).alias("fiftyTwoWeekHigh"),
        F.min(F.when(in_year, F.col("low"))).alias("fiftyTwoWeekLow"),
        mean(F.col("volume"), 10).alias("averageDailyVolume10Day"),
    )
