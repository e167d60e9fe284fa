"""T1, T2 with event time: ticks as a stream, daily bars once a day is over, late ticks in a table of their own.

Two streams follow each other:

* ``split_late`` writes each arrival as two tables. A tick is late if the watermark had passed the end of its day before
  its batch began; the watermark is the newest time of all batches before, less the allowed delay.
* ``close_days`` reads the ticks in time, keeps the bars of open days in Spark's state store, and appends a bar when the
  watermark passes the end of its day. The state holds one row per symbol and open day, whatever the history.

Every tick is in one bar or late. Both streams restart from their checkpoints: the ticks in time of a batch appear by
one rename, which is the last step, so a batch that runs again either finds it or makes the same rows anew.

A tick without a time is late. Ticks without a price or a size count like others; the bar ignores the NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quoteloom.session import glob, remove, rename, stage, temporary_stages
from quoteloom.sources.files import literal, read_partitions

TICKS = "symbol string, ts timestamp, price double, size bigint, tick_key decimal(38,0)"
BARS_OF_DAYS = "symbol string, date date, open double, high double, low double, close double, volume bigint, n_ticks bigint"
PROGRESS = "newest timestamp, batch bigint"


def as_ticks(rows: DataFrame, price: str, size: str, order: Column) -> DataFrame:
    """The stream's columns; ``order`` ranks the ticks of a symbol and day."""
    return rows.select(
        F.col("symbol").cast("string"), F.col("ts").cast("timestamp"), F.col(price).cast("double").alias("price"),
        F.col(size).cast("bigint").alias("size"), order.cast("decimal(38,0)").alias("tick_key"),
    )


def _watermark(spark: SparkSession, path: str, batch: int, delay: str):
    """Watermark before a batch; None before the first."""
    known = read_partitions(spark, f"{path}/progress", f"{path}/progress", PROGRESS).where(F.col("batch") < batch)
    return known.agg((F.max("newest") - F.expr(f"INTERVAL {delay}")).alias("w")).first()["w"]


def split_late(ticks: DataFrame, path: str, delay: str) -> StreamingQuery:
    """Streaming ``ticks`` (see :func:`as_ticks`) to ``in_time`` and ``late`` below ``path``, one partition a batch."""

    def split(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        done, arriving = f"{path}/in_time/batch={number}", f"{path}/arriving/batch={number}"
        if glob(spark, literal(done)):
            return
        mark = _watermark(spark, path, number, delay)
        day_end = F.date_trunc("day", "ts") + F.expr("INTERVAL 1 DAY")
        is_late = F.col("ts").isNull() | (F.lit(False) if mark is None else day_end <= F.lit(mark))
        with temporary_stages(spark):
            rows = stage(batch, "arrived-ticks")
            rows.where(is_late).write.mode("overwrite").parquet(f"{path}/late/batch={number}")
            newest = rows.agg(F.max("ts").alias("newest"))
            newest.write.mode("overwrite").parquet(f"{path}/progress/batch={number}")
            rows.where(~is_late).write.mode("overwrite").parquet(arriving)
            remove(spark, f"{arriving}/_SUCCESS")
            rename(spark, arriving, done)

    writer = ticks.writeStream.foreachBatch(split).option("checkpointLocation", f"{path}/checkpoints/split")
    return writer.trigger(availableNow=True).start()


def _bars(ticks: DataFrame) -> DataFrame:
    p, k = F.col("price"), F.col("tick_key")
    return ticks.groupBy("symbol", F.window("ts", "1 day").alias("day")).agg(
        F.min_by(p, k).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"), F.max_by(p, k).alias("close"),
        F.sum("size").alias("volume"), F.count("*").alias("n_ticks"),
    ).select("symbol", F.col("day.start").cast("date").alias("date"), "open", "high", "low", "close", "volume", "n_ticks")


def close_days(spark: SparkSession, path: str, delay: str) -> StreamingQuery:
    """Bars of the days that are over, appended to ``closed`` below ``path``."""
    ticks = spark.readStream.schema(TICKS).parquet(f"{path}/in_time/batch=*").withWatermark("ts", delay)
    writer = _bars(ticks).writeStream.outputMode("append").format("parquet")
    writer = writer.option("path", f"{path}/closed").option("checkpointLocation", f"{path}/checkpoints/close")
    return writer.trigger(availableNow=True).start()


def run_tick_stream(ticks: DataFrame, path: str, delay: str = "1 day") -> None:
    """All that has arrived, through both streams. Call it again, also after a crash, for what arrives later."""
    spark = ticks.sparkSession
    split_late(ticks, path, delay).awaitTermination()
    if not glob(spark, f"{literal(path)}/in_time/batch=*"):
        return
    closing = close_days(spark, path, delay)
    closing.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in closing.recentProgress for s in p.stateOperators)
    if dropped:  # its watermark never runs ahead of the first stream's
        raise RuntimeError(f"{dropped} ticks in time came after their day was closed")


def closed_bars(spark: SparkSession, path: str) -> DataFrame:
    if not glob(spark, f"{literal(path)}/closed/*"):
        return spark.createDataFrame([], BARS_OF_DAYS)
    return spark.read.schema(BARS_OF_DAYS).parquet(f"{path}/closed")


def open_bars(spark: SparkSession, path: str) -> DataFrame:
    """Bars so far of days that are not over, of the ticks in time alone."""
    ticks = read_partitions(spark, f"{path}/in_time", f"{path}/in_time", TICKS + ", batch bigint").drop("batch")
    bars, closed = _bars(ticks), closed_bars(spark, path).select(F.col("symbol").alias("_symbol"), F.col("date").alias("_date"))
    return bars.join(closed, F.col("symbol").eqNullSafe(F.col("_symbol")) & (F.col("date") == F.col("_date")), "left_anti")


def late_ticks(spark: SparkSession, path: str) -> DataFrame:
    """Ticks whose day was over when they came, with the number of their batch."""
    return read_partitions(spark, f"{path}/late", f"{path}/late", TICKS + ", batch bigint")
