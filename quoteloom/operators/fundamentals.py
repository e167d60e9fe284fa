"""Company statements to one wide row per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.functions.text import nan_to_null, number
from quoteloom.schemas import SUMMARY_COLUMNS

# How many periods are kept, and the text a line item's name must contain.
QUARTERS = 12
YEARS = 5
LINE_ITEMS = {
    "net_income": "net income",
    "revenue": "revenue",
    "operating_income": "operating income",
}


def statements_from_wide(matrix: DataFrame, freq: str, item: str = "item", item_pos: str = "item_pos") -> DataFrame:
    """One statement matrix (columns named by period end) to long rows."""
    periods = [c for c in matrix.columns if c not in ("symbol", item, item_pos)]
    rows = F.array(
        *[
            F.struct(F.lit(p).cast("date").alias("period_end"), F.col(f"`{p}`").cast("double").alias("value"))
            for p in periods
        ]
    )
    return matrix.select(
        "symbol", F.lit(freq).alias("freq"), F.col(item).alias("item"),
        F.col(item_pos).cast("bigint").alias("item_pos"), F.inline(rows),
    )


def _matches(kind: str) -> Column:
    return F.contains(F.lower("item"), F.lit(LINE_ITEMS[kind]))


def first_matching_items(statements: DataFrame) -> DataFrame:
    """Name of the first line item per symbol and frequency that matches each kind."""
    picks = [
        F.min_by("item", F.when(_matches(k), F.col("item_pos"))).alias(f"{k}_item") for k in LINE_ITEMS
    ]
    return statements.groupBy("symbol", "freq").agg(*picks)


def statement_slots(statements: DataFrame) -> DataFrame:
    """One row per (symbol, freq, period) with its slot number, newest first.

    Each kind's value comes from the symbol's first matching line item; a period where that item is
    missing keeps its slot with NULL. The statement rows are reduced to one row per period (map-side
    combine) before anything is grouped by symbol, so a symbol's group is as long as its list of
    periods. Rows leave here partitioned by symbol.
    """
    kinds = list(LINE_ITEMS)
    pos = {k: F.when(_matches(k), F.col("item_pos")) for k in kinds}
    per_period = statements.groupBy("symbol", "freq", "period_end").agg(
        *[F.min_by(nan_to_null(F.col("value")), pos[k]).alias(k) for k in kinds],
        *[F.min(pos[k]).alias(f"_{k}") for k in kinds],
    )
    group = Window.partitionBy("symbol", "freq")
    first = {k: F.min(f"_{k}").over(group) for k in kinds}
    return (
        per_period.repartition("symbol")
        .select(
            "symbol", "freq", "period_end",
            F.row_number().over(group.orderBy(F.desc("period_end"))).alias("slot"),
            *[F.when(F.col(f"_{k}") == first[k], F.col(k)).alias(k) for k in kinds],
            first["net_income"].isNotNull().alias("has_net_income"),
        )
    )


def fundamentals_wide(statements: DataFrame, quarters: int = QUARTERS, years: int = YEARS) -> DataFrame:
    """One row per symbol, ``q1_* .. q12_*`` and ``y1_* .. y5_*`` with a fixed column list.

    The slots of a symbol (at most 12 + 5) become two sorted arrays and each column reads one element:
    two aggregates instead of the 63 of a pivot. The rows are already partitioned by symbol, so this
    step adds no shuffle.
    """
    slots = statement_slots(statements)
    quarterly, yearly = F.col("freq") == "q", F.col("freq") == "y"
    kept = slots.filter((quarterly & (F.col("slot") <= quarters)) | (yearly & (F.col("slot") <= years)))
    row = F.struct(
        "slot", F.when(F.col("has_net_income"), F.col("period_end")).alias("dated"), *LINE_ITEMS
    )
    arrays = kept.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.when(quarterly, row))).alias("q"),
        F.sort_array(F.collect_list(F.when(yearly, row))).alias("y"),
    )
    columns = []
    for i in range(1, quarters + 1):
        slot = F.get("q", F.lit(i - 1))
        columns += [
            slot["net_income"].alias(f"q{i}_net_income"),
            slot["dated"].alias(f"q{i}_date"),
            slot["revenue"].alias(f"q{i}_revenue"),
            slot["operating_income"].alias(f"q{i}_operating_income"),
        ]
    for i in range(1, years + 1):
        slot = F.get("y", F.lit(i - 1))
        columns += [
            slot["net_income"].alias(f"y{i}_net_income"),
            F.year(slot["dated"]).alias(f"y{i}_year"),
            slot["revenue"].alias(f"y{i}_revenue"),
        ]
    return arrays.select("symbol", *columns)


def with_fundamentals(attributes: DataFrame, wide: DataFrame) -> DataFrame:
    """Attributes of every symbol and its periods where it has statements."""
    return attributes.join(wide, "symbol", "left")


def fundamentals_summary(table: DataFrame) -> DataFrame:
    """The summary columns that exist, largest market cap first, missing last."""
    present = [c for c in SUMMARY_COLUMNS if c in table.columns]
    out = table.select(*present) if present else table
    if "marketCap" not in out.columns:
        return out
    out = out.withColumn("marketCap", number(F.col("marketCap").cast("string")))
    ties = ["symbol"] if "symbol" in out.columns else []
    return out.orderBy(F.desc_nulls_last("marketCap"), *ties)


def missing_summary_columns(table: DataFrame) -> list[str]:
    return [c for c in SUMMARY_COLUMNS if c not in table.columns]


def growth(values: DataFrame, steps: int, step: str = "quarter", value: str = "value") -> DataFrame:
    """Value against the one ``steps`` periods earlier, as a fraction; NULL if there is none or it is 0.

    The earlier value is looked up by period number, not by row, so a missing period is no match.
    Input is one row per (symbol, period_end).
    """
    number_of = F.year("period_end") * (4 if step == "quarter" else 1)
    if step == "quarter":
        number_of = number_of + F.quarter("period_end")
    rows = values.withColumn("_period", number_of)
    back = Window.partitionBy("symbol").orderBy("_period").rangeBetween(-steps, -steps)
    before = F.max(value).over(back)
    return (
        rows.withColumn("_before", before)
        .withColumn("growth", F.try_divide(F.col(value) - F.col("_before"), F.col("_before")))
        .drop("_period", "_before")
    )


def margins(statements: DataFrame) -> DataFrame:
    """Profit and operating margin per symbol and period, NULL without revenue."""
    slots = statement_slots(statements)
    return slots.select(
        "symbol", "freq", "period_end",
        F.try_divide(F.col("net_income"), F.col("revenue")).alias("profit_margin"),
        F.try_divide(F.col("operating_income"), F.col("revenue")).alias("operating_margin"),
    )
