"""Q4, Q5, Q9: universe with flags, selection by choice, lists from directory and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.choices import LISTED_INDEXES, choice_kind, known_key, parse_choice
from quoteloom.operators.directory import directory_symbols
from quoteloom.operators.info import info_for, provider_info
from quoteloom.operators.pages import all_index_members
from quoteloom.operators.universe import (
    build_universe,
    by_choice,
    clean_web_symbols,
    flag_columns,
    flag_table,
    membership,
    restrict,
)
from quoteloom.session import stage
from quoteloom.sinks.tables import (
    write_choice,
    write_flag_table,
    write_index_lists,
    write_info,
    write_lists,
)
from quoteloom.sources.lists import read_choice, read_universe


def index_lists(universe: DataFrame) -> DataFrame:
    """K6: members of the listed indexes, (symbol, index_key)."""
    keys = [known_key(n) for n in LISTED_INDEXES]
    return membership(universe).filter(F.col("index_key").isin(keys))


def run_universe(spark: SparkSession, universe_file: str, out: str) -> DataFrame:
    """Q4: flag table and index lists; returns the staged universe."""
    universe = stage(build_universe(read_universe(spark, universe_file)), "universe")
    write_index_lists(index_lists(universe), f"{out}/index_lists")
    write_flag_table(flag_table(universe.drop("pos")), f"{out}/flags")
    return universe


def run_choice(spark: SparkSession, choice: int | str, universe: DataFrame | None, folders: list[str], out: str) -> None:
    """Q5: choice 0, each single choice, and their combination, three tables each.

    A choice with one of the list-only numbers reads symbol lists; the others filter the universe by
    index flags.
    """
    kind = choice_kind(choice)
    numbers = parse_choice(choice)
    labels = list(dict.fromkeys(["0", *[str(n) for n in numbers], str(choice)]))
    if universe is not None:
        universe = stage(universe, "universe")
        flagged = stage(flag_columns(universe), "flagged")
    for label in labels:
        if label == "0" and universe is not None:
            write_choice(flagged, label, out)
        elif kind == "flags" and universe is not None:
            write_choice(by_choice(flagged, label), label, out)
        else:
            write_choice(read_choice(spark, label, folders).orderBy("pos"), label, out, rich=False)


def run_lists(
    spark: SparkSession,
    directory: DataFrame,
    pages: DataFrame,
    universe: DataFrame,
    out: str,
    choice: int | str = 1,
    own_lists: dict[str, DataFrame] | None = None,
    folders: list[str] | None = None,
) -> None:
    """One symbol list per source, and provider-style info of a choice.

    A choice of index flags filters the universe by them, one with a list-only number by the symbols of its
    lists (from ``folders``). The cleaned universe and its info come besides. Every list keeps its order.
    """
    groups = {"nasdaq_all": directory_symbols(directory)}
    groups["universe"] = universe
    groups["universe_clean"] = clean_web_symbols(universe)
    groups.update(own_lists or {})
    rows = [_listed(df).withColumn("group", F.lit(name)) for name, df in groups.items()]
    rows.append(all_index_members(pages).select("symbol", F.col("pos").cast("decimal(38,0)").alias("pos"), "group"))
    write_lists(reduce(DataFrame.unionByName, rows), f"{out}/lists")
    if choice_kind(choice) == "flags":
        chosen = by_choice(universe, choice)
    else:
        chosen = restrict(universe, read_choice(universe.sparkSession, choice, folders or []))
    write_info(provider_info(chosen), choice, f"{out}/provider_info")
    write_info(provider_info(clean_web_symbols(universe)), "clean", f"{out}/provider_info")


def _listed(df: DataFrame) -> DataFrame:
    pos = F.col("pos").cast("decimal(38,0)") if "pos" in df.columns else F.lit(None).cast("decimal(38,0)")
    return df.select("symbol", pos.alias("pos"))


def run_info(universe: DataFrame, symbols: DataFrame, choice: int | str, out: str) -> DataFrame:
    """Q8: info rows of the requested symbols."""
    rows = stage(info_for(universe, symbols), "info")
    write_info(rows, choice, f"{out}/info")
    return rows
