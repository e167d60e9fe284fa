"""Company information next to symbols and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.operators.dedup import keep_first
from quoteloom.operators.universe import restrict
from quoteloom.schemas import NUMBER_ATTRIBUTES, SNAPSHOT_ATTRIBUTES, TEXT_ATTRIBUTES
from quoteloom.functions.text import number, present

# Info columns and the universe columns they come from.
INFO_COLUMNS = [
    ("description", "description"),
    ("market_capitalization", "market_cap"),
    ("market_cap_currency", "market_cap_currency"),
    ("sector", "sector"),
    ("industry", "industry"),
    ("exchange", "exchange"),
    ("analyst_rating", "analyst rating"),
    ("upcoming_earnings_date", "upcoming earnings date"),
    ("recent_earnings_date", "recent earnings date"),
]

# Provider-style info columns and the universe columns they come from.
PROVIDER_COLUMNS = [
    ("longName", "description"),
    ("sector", "sector"),
    ("industry", "industry"),
    ("exchange", "exchange"),
    ("marketCap", "market_cap"),
    ("upcoming earnings", "upcoming earnings date"),
    ("recent earnings", "recent earnings date"),
]


def _or_null(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def info(universe: DataFrame) -> DataFrame:
    """The info columns; what the universe lacks is NULL."""
    return universe.select("symbol", *[_or_null(universe, src).alias(out) for out, src in INFO_COLUMNS])


def provider_info(universe: DataFrame) -> DataFrame:
    """The same rows under provider-style names."""
    return universe.select("symbol", *[_or_null(universe, src).alias(out) for out, src in PROVIDER_COLUMNS])


def info_for(universe: DataFrame, symbols: DataFrame) -> DataFrame:
    """J2 + P13: info of the requested symbols only."""
    return info(restrict(universe, symbols))


def clean_info(info_rows: DataFrame, delivered: DataFrame, order=None) -> DataFrame:
    """Info of the symbols that were delivered, one row per symbol."""
    rows = restrict(info_rows, delivered)
    return rows if order is None else keep_first(rows, ["symbol"], order)


def portfolio_clean_info(info_rows: DataFrame, delivered: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Info of the delivered symbols that are in the portfolio."""
    return clean_info(info_rows, restrict(delivered, portfolio))


def with_attributes(bars: DataFrame, attributes: DataFrame) -> DataFrame:
    """Snapshot attributes on every bar of the symbol, those of them that exist.

    Many bars to one attribute row. Spark broadcasts the attributes if they measure small; otherwise
    the sort-merge join's hot symbols are split by AQE, as only the bar side can be skewed.
    """
    names = [n for n, _ in SNAPSHOT_ATTRIBUTES if n in attributes.columns]
    renamed = [F.col(n).alias(n if n not in bars.columns else f"snapshot_{n}") for n in names]
    return bars.join(attributes.select("symbol", *renamed), "symbol", "left")


def attribute_schema() -> str:
    """All company attributes as text: a provider may send a missing-value text for a number."""
    return ", ".join(f"`{n}` string" for n in [*TEXT_ATTRIBUTES, *NUMBER_ATTRIBUTES])


def attributes_from_json(landed: DataFrame, json: str = "json") -> DataFrame:
    """One landed JSON document per symbol to typed columns.

    Absent and missing values are NULL (P19, N3). Only the columns used later are parsed from the text.
    """
    parsed = landed.select("symbol", F.from_json(json, attribute_schema()).alias("a"))
    texts = [present(F.col(f"a.{n}")).alias(n) for n in TEXT_ATTRIBUTES]
    numbers = [number(F.col(f"a.{n}")).alias(n) for n in NUMBER_ATTRIBUTES]
    return parsed.select("symbol", *texts, *numbers)


def info_from_attributes(attributes: DataFrame) -> DataFrame:
    """Provider attributes under the info names; the currency defaults to USD.

    ``earningsDate`` is used when it was landed; the other dates and the rating have no provider field.
    """
    return attributes.select(
        "symbol",
        F.col("shortName").alias("description"),
        F.col("marketCap").alias("market_capitalization"),
        F.coalesce("currency", F.lit("USD")).alias("market_cap_currency"),
        "sector", "industry", "exchange",
        F.lit(None).cast("string").alias("analyst_rating"),
        _or_null(attributes, "earningsDate").alias("upcoming_earnings_date"),
        F.lit(None).cast("string").alias("recent_earnings_date"),
    )
