"""One ratio per day, from landed pages."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.text import number


# Fixed value: where the ratio stands in a landed page.
RATIO_PATTERN = r">EQUITY PUT/CALL RATIO</td><td[^>]*>([\d.]+)</td>"

# How many new values one run adds, and how many days it looks at per value.
LOOKBACK = 10
DAYS_PER_VALUE = 3


def ratio_from_page(pages: DataFrame, pattern: str = RATIO_PATTERN) -> DataFrame:
    """The ratio in each page; pages without one (nothing published) are dropped."""
    value = number(F.regexp_extract("html", pattern, 1))
    return pages.withColumn("ratio", value).filter(F.col("ratio").isNotNull()).drop("html")


def gap_dates(known: DataFrame, today: date, lookback: int = LOOKBACK) -> DataFrame:
    """Days to fill: up to ``today``, after the newest known day, at most 3 x lookback back.

    The calendar is a sequence of at most 3 x lookback days; the known series is only asked for its
    newest day up to ``today``, which is one aggregate.
    """
    first = today - timedelta(days=DAYS_PER_VALUE * lookback - 1)
    newest = known.filter(F.col("date") <= F.lit(today)).agg(F.max("date"))
    calendar = known.sparkSession.range(1).select(
        F.explode(F.sequence(F.lit(first), F.lit(today))).alias("date")
    )
    after = F.coalesce(newest.scalar(), F.date_sub(F.lit(first), 1))
    return calendar.filter(F.col("date") > after)


def new_values(published: DataFrame, known: DataFrame, today: date, lookback: int = LOOKBACK) -> DataFrame:
    """The newest ``lookback`` days in the gap that have a published value.

    A day that was landed more than once is one day; of differing values the largest counts.
    """
    gaps = gap_dates(known, today, lookback)
    found = published.select("date", "ratio").join(gaps, "date", "left_semi")
    found = found.groupBy("date").agg(F.max("ratio").alias("ratio"))
    return found.orderBy(F.desc("date")).limit(lookback)


def refresh(known: DataFrame, published: DataFrame, today: date, lookback: int = LOOKBACK) -> DataFrame:
    """The series with its gap filled; a new value wins over a stored one.

    One row per day on both sides, so the union is grouped and neither side is evaluated twice.
    """
    new = new_values(published, known, today, lookback)
    both = known.select("date", "ratio", F.lit(0).alias("rank")).unionByName(new.withColumn("rank", F.lit(1)))
    return both.groupBy("date").agg(F.max_by("ratio", "rank").alias("ratio")).orderBy("date")


def latest_value(series: DataFrame) -> DataFrame:
    """O7."""
    return series.agg(F.max("date").alias("date"), F.max_by("ratio", "date").alias("ratio"))
