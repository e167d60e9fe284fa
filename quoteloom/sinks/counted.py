"""Writes that count what they write (A2, A9), and distinct counts per date that merge.

Counts are observed on the write itself, behind its shuffle, so they need no other scan and a recomputed map task is
not counted twice. Numbers of rows, dates and outcomes are exact. The number of distinct symbols comes from a sketch:
it is within :func:`bound` of the exact one but for one case in some ten thousand.

``date_sketches`` keeps rows and a sketch of symbols for each date; the counts of any range of dates follow from those
few rows without reading bars.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quoteloom.operators.merge import upsert_new_wins
from quoteloom.session import stage
from quoteloom.sinks.tables import BAR_PARTITIONS, ordered_by_partition, replace_state
from quoteloom.sources.files import read_table

SKETCHES = "interval string, source string, date date, rows bigint, symbols binary"
# A sketch has 2 ** LOG_SIZE registers of one byte.
LOG_SIZE = 12


def bound() -> float:
    """Relative error that a distinct count keeps: four standard errors of the sketch, 1.04 / sqrt(registers) each."""
    return 4 * 1.04 / 2 ** (LOG_SIZE / 2)


def replace_dates_counted(bars: DataFrame, path: str, outcomes: dict[str, Column] | None = None) -> dict[str, int]:
    """K1 with the counts ``rows``, ``dates``, ``symbols`` (by sketch) and one for each condition of ``outcomes``.

    The dates are gathered as a set, which the calendar bounds. A NULL date or symbol counts as none.
    """
    seen = Observation()
    counts = {
        "rows": F.count("*"), "dates": F.size(F.collect_set("date")),
        "symbols": F.hll_sketch_estimate(F.hll_sketch_agg("symbol", LOG_SIZE)),
    }
    counts |= {name: F.count_if(condition) for name, condition in (outcomes or {}).items()}
    (
        ordered_by_partition(bars).observe(seen, *[c.cast("bigint").alias(n) for n, c in counts.items()])
        .write.partitionBy(*BAR_PARTITIONS)
        .mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    return {name: seen.get.get(name) or 0 for name in counts}


def date_sketches(bars: DataFrame) -> DataFrame:
    """Rows and symbols of each date; partial sketches are made before the shuffle, so a date may hold any number of bars."""
    return bars.groupBy(*BAR_PARTITIONS).agg(F.count("*").alias("rows"), F.hll_sketch_agg("symbol", LOG_SIZE).alias("symbols"))


def merge_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("symbols").alias("symbols"))


def keep_sketches(spark: SparkSession, bars: DataFrame, path: str, added: bool = False) -> None:
    """Bring the stored sketches up to date with bars that replaced their dates, or were ``added`` to them."""
    old, new = read_table(spark, path, SKETCHES), date_sketches(bars)
    both = merge_sketches(old.unionByName(new), BAR_PARTITIONS) if added else upsert_new_wins(old, stage(new, "sketches"), BAR_PARTITIONS)
    replace_state(both.coalesce(1), path)


def counts_between(sketches: DataFrame, start: date | None = None, end: date | None = None, by: Column | None = None) -> DataFrame:
    """``rows``, ``dates`` and ``symbols`` of ``start <= date < end``, for each value of ``by``, such as a month."""
    if start is not None:
        sketches = sketches.where(F.col("date") >= F.lit(start))
    if end is not None:
        sketches = sketches.where(F.col("date") < F.lit(end))
    return sketches.groupBy(*([] if by is None else [by])).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.countDistinct("date").alias("dates"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("symbols")), F.lit(0)).alias("symbols"),
    )
