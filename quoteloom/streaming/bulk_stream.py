"""Bulk files dropped into a folder are merged as they arrive.

The result does not depend on how files are dealt to micro-batches. A ledger beside the bars keeps, for each symbol
and date that the stream added, the file and row it came from; a later row of a later file takes its place, an
earlier one does not, just as in one batch over all files. A batch that is run again changes nothing. Late files are
merged like others; there is no watermark, as no state waits for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quoteloom.operators.dedup import keep_last
from quoteloom.operators.universe import restrict
from quoteloom.session import stage, temporary_stages
from quoteloom.sinks.tables import as_bars, replace_dates
from quoteloom.sources.bulk import read_bulk
from quoteloom.sources.files import read_table
from quoteloom.sources.history import read_bars

FILE_ROWS = "path string, modificationTime timestamp, length bigint, content binary"


LEDGER = (
    "symbol string, open double, high double, low double, close double, volume bigint, file_name string, "
    "row_order decimal(38,0), date date"
)


def merge_in_file_order(rows: DataFrame, bars_path: str, ledger_path: str, interval: str = "1d") -> None:
    """Merge rows with ``file_name`` and ``row_order``: the last writer wins over all that the ledger knows.

    Bars that others stored win over both. The ledger is written first: after a crash between the two writes the
    same batch finds its rows there and completes the bars.
    """
    spark = rows.sparkSession
    names = [f.split()[0] for f in LEDGER.split(", ")]
    given = [
        (F.col(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n)
        for n, kind in (f.split() for f in LEDGER.split(", "))
    ]
    new = stage(rows.select(*given), "arrived")
    dates = [r[0] for r in new.select("date").distinct().collect()]
    if not dates:
        return
    touched = F.col("date").isin(dates)
    known = stage(read_table(spark, ledger_path, LEDGER).select(*names).filter(touched), "known")
    stored = read_bars(spark, bars_path, interval).filter(touched)
    others = stage(stored.join(known.select("symbol", "date"), ["symbol", "date"], "left_anti").select(*stored.columns), "others")
    last = keep_last(known.unionByName(new), ["symbol", "date"], ["file_name", "row_order"])
    last = stage(last.join(others.select("symbol", "date"), ["symbol", "date"], "left_anti").select(*names), "last")
    writer = last.write.partitionBy("date").mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.parquet(ledger_path)
    bars = as_bars(last, interval, "bulk")
    bars = bars.unionByName(others.filter(F.col("source") == "bulk").select(*bars.columns))
    replace_dates(stage(bars, "bars"), bars_path)


def ledger_of(bars_path: str) -> str:
    return f"{bars_path.rstrip('/')}-ledger"


def stream_bulk_files(
    spark: SparkSession,
    folder: str,
    symbols: DataFrame | None,
    bars_path: str,
    checkpoint: str,
    interval: str = "1d",
    files_per_batch: int = 100,
) -> StreamingQuery:
    """Watch a folder of bulk files with any mix of headers.

    The stream carries file paths only (file content is never read through it); each batch reads its
    files by header and merges them.
    """
    paths = (
        spark.readStream.format("binaryFile").schema(FILE_ROWS)
        .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", files_per_batch)
        .load(folder).select("path")
    )

    def merge(batch: DataFrame, _: int) -> None:
        found = sorted(r["path"] for r in batch.collect())
        if found:
            with temporary_stages(batch.sparkSession):
                rows = read_bulk(batch.sparkSession, found)
                rows = rows if symbols is None else restrict(rows, symbols)
                merge_in_file_order(rows, bars_path, ledger_of(bars_path), interval)

    return paths.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_bar_rows(
    rows: DataFrame,
    to_rows: Callable[[DataFrame], DataFrame],
    bars_path: str,
    checkpoint: str,
    interval: str = "1d",
) -> StreamingQuery:
    """The same merge for a stream of rows; ``to_rows`` gives bars with ``file_name`` and ``row_order``."""

    def merge(batch: DataFrame, _: int) -> None:
        with temporary_stages(batch.sparkSession):
            merge_in_file_order(to_rows(batch), bars_path, ledger_of(bars_path), interval)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
