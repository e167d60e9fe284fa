"""Q6, Q10: fundamentals table and summary; optional score and screen."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.operators.fundamentals import fundamentals_summary, fundamentals_wide, with_fundamentals
from quoteloom.operators.screen import growth_acceleration, score, screen
from quoteloom.operators.universe import restrict
from quoteloom.session import stage
from quoteloom.sinks.tables import replace_table, write_fundamentals


def fundamentals_table(attributes: DataFrame, statements: DataFrame, symbols: DataFrame, now: datetime) -> DataFrame:
    """Attributes and periods of the requested symbols, stamped with ``now``."""
    table = with_fundamentals(restrict(attributes, symbols), fundamentals_wide(restrict(statements, symbols)))
    return table.withColumn("last_updated", F.lit(now.strftime("%Y-%m-%d %H:%M:%S")))


def run_fundamentals(
    attributes: DataFrame, statements: DataFrame, symbols: DataFrame, now: datetime, out: str, scored: bool = False
) -> DataFrame:
    """Write table and summary, and with ``scored`` the screened rows; returns the table."""
    table = fundamentals_table(attributes, statements, symbols, now)
    if scored:
        table = score(growth_acceleration(table))
    table = stage(table, "fundamentals")
    write_fundamentals(table, fundamentals_summary(table), out)
    if scored:
        replace_table(screen(table).orderBy(F.desc_nulls_last("canslim_score"), "symbol"), f"{out}/screened")
    return table
