"""Positions 1..n in an order, without a window over all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.session import stage

# ``monotonically_increasing_id`` has the row's place in the lower bits and its partition above.
PLACE_BITS = 33


def dense_positions(df: DataFrame, order: list[str], column: str = "pos") -> DataFrame:
    """``df`` with the position of each row by the columns ``order`` (NULL first); ``column`` is replaced if it is there.

    Rows are sorted by ranges, one task a range, and written with their place inside it. What comes before each range is
    a running sum over one count per range, which is as many rows as there are shuffle partitions. Rows that tie in
    ``order`` get different positions; which one gets which is open. An empty table stays empty.
    """
    kept = [c for c in df.columns if c.lower() != column.lower()]
    place = F.monotonically_increasing_id().alias("_place")
    # The order may name the column that is replaced, so it is sorted before that one goes.
    ranged = df.repartitionByRange(*[F.col(f"`{c}`") for c in order]).sortWithinPartitions(*[F.col(f"`{c}`") for c in order])
    rows = stage(ranged.select(*[F.col(f"`{c}`") for c in kept], place), "numbered")
    rows = rows.withColumn("_range", F.shiftright("_place", PLACE_BITS))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = rows.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", before.alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    numbered = rows.join(F.broadcast(offsets), "_range")  # a row per shuffle partition
    return numbered.select(*[F.col(f"`{c}`") for c in kept], (F.col("_before") + inside + 1).cast("bigint").alias(column))
