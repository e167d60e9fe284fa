"""The pipe-separated exchange directory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.symbols import exchange_name
from quoteloom.functions.text import strip

# Fields of a directory line, and the pattern of a plain symbol.
SYMBOL_FIELD, EXCHANGE_FIELD, FUND_FIELD, TEST_FIELD = 1, 3, 5, 7
PLAIN_SYMBOL = "^[A-Z]+$"


def directory_symbols(lines: DataFrame, column: str = "value") -> DataFrame:
    """Plain symbols that are neither funds nor test issues, once each, with their exchange (B2).

    Lines with fewer than eight fields are skipped. A repeated symbol keeps the exchange of its last line
    when the lines have a ``pos``, else the greatest name.
    """
    f = F.split(strip(F.col(column)), r"\|")
    pos = F.col("pos") if "pos" in lines.columns else exchange_name(F.get(f, F.lit(EXCHANGE_FIELD)))
    fields = lines.select(f.alias("f"), pos.alias("pos")).filter(F.size("f") > TEST_FIELD)
    kept = fields.select(
        "pos",
        F.get("f", F.lit(SYMBOL_FIELD)).alias("symbol"),
        exchange_name(F.get("f", F.lit(EXCHANGE_FIELD))).alias("exchange"),
        F.get("f", F.lit(FUND_FIELD)).alias("fund"),
        F.get("f", F.lit(TEST_FIELD)).alias("test"),
    ).filter((F.col("fund") == "N") & (F.col("test") == "N") & F.col("symbol").rlike(PLAIN_SYMBOL))
    return kept.groupBy("symbol").agg(F.max_by("exchange", "pos").alias("exchange"))
