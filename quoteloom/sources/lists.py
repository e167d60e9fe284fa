"""Symbol lists, portfolios, universes, directories, landed pages and attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.choices import lists_for, parse_choice
from quoteloom.functions.text import blank_to_null
from quoteloom.operators.universe import union_lists
from quoteloom.schemas import PAGES
from quoteloom.sources.files import columns_of, exists, field, first_existing, read_csv, read_wide_csv, row_order

SYMBOL_HEADERS = ["Symbol", "ticker", "symbol"]


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, pos) from a file whose column is ``Symbol`` or ``ticker``.

    Only an empty field is missing: a symbol spelled ``NA`` stays (N1).
    """
    if not set(SYMBOL_HEADERS) & set(columns_of(spark, path)):
        raise ValueError(f"{path} has none of the columns {SYMBOL_HEADERS}")
    rows = read_csv(spark, [path])
    out = rows.select(blank_to_null(field(*SYMBOL_HEADERS)).alias("symbol"), F.col("row_order").alias("pos"))
    return out.filter(F.col("symbol").isNotNull())


def read_choice(spark: SparkSession, choice: int | str, folders: list[str]) -> DataFrame:
    """Union of the lists of a choice, each from the first folder that has it; missing ones are skipped."""
    found = []
    for name in lists_for(parse_choice(choice)):
        places = [f"{folder.rstrip('/')}/{name}.csv" for folder in folders]
        if any(exists(spark, p) for p in places):
            found.append(read_symbols(spark, first_existing(spark, places)))
    if not found:
        raise FileNotFoundError(f"no symbol list for choice {choice} in {folders}")
    return union_lists(found)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """A wide universe file with all its columns as text, and ``pos``."""
    return read_wide_csv(spark, path).withColumnRenamed("row_order", "pos")


def read_directory(spark: SparkSession, path: str) -> DataFrame:
    """Directory lines with ``pos``, the header line left out."""
    lines = spark.read.text(path).select("value", row_order().alias("pos"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.filter("at = 0").agg(F.min("pos"))
    return lines.filter(F.col("pos") > first.scalar()).select("value", "pos")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages as (url, html)."""
    return spark.read.schema(PAGES).parquet(path)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per line as (symbol, json); the document's own symbol names the row."""
    text = spark.read.text(path)
    return text.select(F.get_json_object("value", "$.symbol").alias("symbol"), F.col("value").alias("json"))
