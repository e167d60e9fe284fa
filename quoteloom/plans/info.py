"""Q8: clean lists after a history run (K9)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quoteloom.operators.info import clean_info, portfolio_clean_info
from quoteloom.session import stage
from quoteloom.sinks.tables import replace_table


def run_clean_lists(
    info_rows: DataFrame, delivered: DataFrame, portfolio: DataFrame, out: str
) -> DataFrame:
    """Clean symbols, clean info and clean portfolio info; returns the clean info."""
    clean = stage(clean_info(info_rows, delivered), "clean")
    replace_table(clean.select("symbol").distinct(), f"{out}/symbols_clean")
    replace_table(clean, f"{out}/info_clean")
    replace_table(portfolio_clean_info(info_rows, delivered, portfolio), f"{out}/portfolio_clean")
    return clean
