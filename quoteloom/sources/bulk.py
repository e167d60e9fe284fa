"""Bulk snapshot files: one row per symbol, the date in the file name."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quoteloom.functions.dates import file_date
from quoteloom.functions.symbols import clean_symbol
from quoteloom.functions.text import number, parses_or_missing, whole
from quoteloom.operators.dedup import keep_last
from quoteloom.schemas import BULK_COLUMNS, empty
from quoteloom.sources.files import computed, field, list_files, read_csv, read_csv_folder

# Above any row position inside one file, see ``row_order``; leaves room for 10**14 files of one date.
FILE_STEP = "1000000000000000000000000"
# What a name with a date looks like to the listing; whether it is a calendar date is decided by ``file_date``.
DATE_GLOB = "-".join(["[0-9]" * 4, "[0-9]" * 2, "[0-9]" * 2])


def dated_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, file_date) of the CSV files with a calendar date in their name."""
    files = list_files(spark, folder).withColumn("file_date", file_date(F.col("name")))
    return files.filter(F.col("file_date").isNotNull())


def latest_files(spark: SparkSession, folder: str) -> tuple[date | None, list[str]]:
    """S3, A5: newest date and all its files. Only names are looked at."""
    files = dated_files(spark, folder)
    newest = files.agg(F.max("file_date")).scalar()
    rows = files.filter(F.col("file_date") == newest).orderBy("name").collect()
    return (rows[0]["file_date"], [r["path"] for r in rows]) if rows else (None, [])


def has_bulk_columns(files: DataFrame) -> DataFrame:
    """The files that have all needed columns, by their header ``names``."""
    has = F.lit(True)
    for header, _ in BULK_COLUMNS:
        has = has & F.array_contains("names", header)
    return files.filter(has)


def bulk_rows(raw: DataFrame) -> DataFrame:
    """P1d, P4, P5, P6: text columns of a snapshot to valid bars.

    Open, price and volume must be numbers; high and low may be missing but must not be other text; a
    volume that fits no bigint rejects its row only (B6). ``raw`` also has ``date``, NULL for a file without
    a date in its name (B10), and the order columns.
    """
    text = {out: F.col(f"`{header}`").cast("string") for header, out in BULK_COLUMNS}
    prices = [number(text[c]).alias(c) for c in ("open", "high", "low", "close")]
    may_miss = parses_or_missing(text["high"]) & parses_or_missing(text["low"])
    bar = F.struct(clean_symbol(text["symbol"]).alias("symbol"), *prices, whole(text["volume"]).alias("volume"), may_miss.alias("valid"))
    keep = [c for c in ("file_name", "file_no", "row_order") if c in raw.columns]
    parsed = computed(raw.select("date", *keep, *[f"`{header}`" for header, _ in BULK_COLUMNS]), "_bar", bar)
    needed = " AND ".join(f"{c} IS NOT NULL" for c in ("date", "_bar.symbol", "_bar.open", "_bar.close", "_bar.volume"))
    return parsed.filter(f"_bar.valid AND {needed}").select(
        "date", *[f"_bar.{c}" for c in ("symbol", "open", "high", "low", "close", "volume")], *keep
    )


def read_bulk(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Valid rows of several files, see :func:`rows_of_files`."""
    return rows_of_files(read_csv(spark, paths, bulk_files))


def read_bulk_folder(
    spark: SparkSession, folder: str, where: Column | None = None, only: DataFrame | None = None, day: date | None = None
) -> DataFrame:
    """As :func:`read_bulk` for all dated files of a folder, those of ``day``, or those that ``where`` and ``only`` keep.

    Files without a date in their name are left out when the folder is listed, and no line is asked for its file's date.
    """
    names = f"*{day or DATE_GLOB}*.csv"
    return rows_of_files(read_csv_folder(spark, folder, where, only, names, lambda files: bulk_files(files, day)))


def bulk_files(files: DataFrame, day: date | None = None) -> DataFrame:
    """The files of ``day``, or with any date, that have all needed columns.

    They get ``date`` and ``file_no``, their rank by name among those of the date.
    """
    dated = has_bulk_columns(files).withColumn("date", file_date(F.col("file_name")))
    dated = dated.filter(F.col("date").isNotNull() if day is None else F.col("date") == F.lit(day))
    by_name = Window.partitionBy("date").orderBy("file_name")
    return dated.withColumn("file_no", F.dense_rank().over(by_name).cast("bigint"))


def rows_of_files(raw: DataFrame) -> DataFrame:
    """Valid rows; a file without a date or the needed columns gives none, see :func:`bulk_files`."""
    text = [field(header).alias(header) for header, _ in BULK_COLUMNS]
    return bulk_rows(raw.select("date", "file_name", "file_no", "row_order", *text))


def last_written(rows: DataFrame) -> DataFrame:
    """One row per (symbol, date): the last row of the file that sorts last by name.

    File number and row position make one fixed-width key, so this is a hash aggregate.
    """
    step = F.lit(FILE_STEP).cast("decimal(38,0)")
    order = F.col("file_no").cast("decimal(14,0)") * step + F.col("row_order")
    ordered = rows.withColumn("row_order", order.cast("decimal(38,0)")).drop("file_no", "file_name")
    return keep_last(ordered, ["symbol", "date"], "row_order").drop("row_order")
