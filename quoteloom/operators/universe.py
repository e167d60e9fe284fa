"""The symbol master: cleaning, index membership, flags and choices."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.choices import FLAG_NAMES, KNOWN_INDEXES, flags_for, known_key, parse_choice
from quoteloom.functions.symbols import (
    clean_batch_symbol,
    clean_symbol,
    clean_web_symbol,
    index_keys_of,
    index_names,
)
from quoteloom.operators.dedup import keep_first

# Normal names of universe columns that are not just the lower-case header.
RENAMED = {
    "market capitalization": "market_cap",
    "market capitalization - currency": "market_cap_currency",
    "ticker": "symbol",
}


# Above any position inside one list, see ``sources.files.row_order``.
LIST_STEP = "1000000000000000000000000"


def normal_name(header: str) -> str:
    name = header.strip().lower()
    return RENAMED.get(name, name)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Blanks around headers removed, lower case, two renamed."""
    return df.toDF(*[normal_name(c) for c in df.columns])


def clean_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """Cleaned symbol in place; rows without one are dropped."""
    return df.withColumn(column, clean_symbol(F.col(column))).filter(F.col(column).isNotNull())


def clean_web_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """As :func:`clean_symbols` with the backslash rule; rows that never had a symbol stay."""
    cleaned = clean_web_symbol(F.col(column))
    return df.filter(F.col(column).isNull() | cleaned.isNotNull()).withColumn(column, cleaned)


def clean_batch_symbols(
    df: DataFrame, order="pos", rejects: DataFrame | None = None, column: str = "symbol"
) -> DataFrame:
    """Clean, one row per symbol (the first), then known rejects removed."""
    cleaned = df.withColumn(column, clean_batch_symbol(F.col(column))).filter(F.col(column).isNotNull())
    once = keep_first(cleaned, [column], order)
    return once if rejects is None else exclude(once, rejects)


def exclude(df: DataFrame, rejects: DataFrame) -> DataFrame:
    """Rows whose symbol is not in ``rejects``; Spark broadcasts the list only if it measures small."""
    return df.join(rejects.select("symbol"), "symbol", "left_anti")


def restrict(df: DataFrame, symbols: DataFrame) -> DataFrame:
    """Rows whose symbol is in ``symbols``."""
    return df.join(symbols.select("symbol"), "symbol", "left_semi")


def build_universe(raw: DataFrame, order="pos") -> DataFrame:
    """Normal headers, clean symbols, first row per symbol, index array.

    ``indexes`` holds the index names as a real array; all later filters on it are row-local.
    """
    df = clean_symbols(normalise_headers(raw))
    df = keep_first(df, ["symbol"], order)
    if "index" not in df.columns:
        return df.withColumn("indexes", F.array().cast("array<string>"))
    return df.withColumn("indexes", F.coalesce(index_names(F.col("index")), F.array().cast("array<string>")))


def index_keys() -> Column:
    return index_keys_of(F.col("indexes"))


def membership(universe: DataFrame) -> DataFrame:
    """M5: one row per (symbol, index key)."""
    return universe.select("symbol", F.explode(index_keys()).alias("index_key"))


def members_per_index(members: DataFrame) -> DataFrame:
    """A1."""
    return members.groupBy("index_key").agg(F.count("*").alias("members"))


def top_indexes(members: DataFrame, n: int = 10) -> DataFrame:
    """The n indexes with most members; ties in key order."""
    return members_per_index(members).orderBy(F.desc("members"), "index_key").limit(n)


def sample_symbols(symbols: DataFrame, n: int = 5, seed: str = "0") -> DataFrame:
    """N symbols picked by a hash, so that a repeated run picks the same ones."""
    return symbols.select("symbol").orderBy(F.md5(F.concat(F.lit(seed), F.col("symbol"))), "symbol").limit(n)


def preview(df: DataFrame, order: str = "pos", n: int = 5) -> DataFrame:
    """The first n rows."""
    return df.orderBy(order).limit(n)


def found_index_keys(universe: DataFrame) -> list[str]:
    """Sorted keys that occur. They become column names, which the driver has to know as part of any plan.

    :func:`membership` is the form for any number of keys.
    """
    return sorted(r[0] for r in membership(universe).select("index_key").distinct().toLocalIterator())


def flag_columns(universe: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One boolean column per index key that occurs (or per given key).

    The keys are looked up in the row's own array, so adding flags never shuffles the universe.
    """
    keys = found_index_keys(universe) if keys is None else keys
    with_keys = universe.withColumn("_keys", index_keys())
    flags = [F.array_contains("_keys", k).alias(k) for k in keys]
    return with_keys.select(*[F.col(f"`{c}`") for c in universe.columns], *flags)


def known_flag_columns(universe: DataFrame) -> DataFrame:
    """One boolean column for each known index name; other names are ignored."""
    flags = [F.array_contains("indexes", name).alias(known_key(name)) for name in KNOWN_INDEXES]
    return universe.select(*[F.col(f"`{c}`") for c in universe.columns], *flags)


def flag_table(universe: DataFrame) -> DataFrame:
    """Symbol, the original columns, the known flags in name order; sorted by symbol.

    Original columns whose name begins like a flag are left out.
    """
    flagged = known_flag_columns(universe)
    flags = sorted(known_key(n) for n in KNOWN_INDEXES)
    originals = [
        c for c in universe.columns
        if c not in ("symbol", "indexes") and not c.startswith(("SP", "NASDAQ", "Russell"))
    ]
    ordered = flagged.select("symbol", *[F.col(f"`{c}`") for c in originals], *flags)
    return ordered.filter(F.col("symbol").isNotNull()).orderBy("symbol")


def by_flags(universe: DataFrame, flags: list[str]) -> DataFrame:
    """Rows in any of the indexes; no flags means all rows, flags nobody has mean none."""
    if not flags:
        return universe
    return universe.filter(F.arrays_overlap(index_keys(), F.array(*[F.lit(f) for f in flags])))


def by_choice(universe: DataFrame, choice: int | str) -> DataFrame:
    """A choice such as ``4``, or several such as ``"1-4"`` (their union)."""
    return by_flags(universe, flags_for(parse_choice(choice)))


def by_every_choice(universe: DataFrame) -> DataFrame:
    """P11 for all defined choices at once, as one row per (choice, symbol).

    Each row is matched in place against the fixed choice table: no join and no shuffle.
    """
    wanted = F.array(
        *[
            F.when(F.arrays_overlap("_keys", F.array(*[F.lit(f) for f in flags])) if flags else F.lit(True), choice)
            for choice, flags in FLAG_NAMES.items()
        ]
    )
    with_keys = universe.withColumn("_keys", index_keys())
    return with_keys.select(F.explode(F.array_compact(wanted)).alias("choice"), *[f"`{c}`" for c in universe.columns])


def flag_filter(flagged: DataFrame, flags: list[str]) -> DataFrame:
    """P11 over stored boolean columns: unknown columns are ignored, if all are unknown no row stays."""
    if not flags:
        return flagged
    known = [F.coalesce(F.col(f"`{f}`"), F.lit(False)) for f in flags if f in flagged.columns]
    return flagged.filter(reduce(lambda a, b: a | b, known, F.lit(False)))


def union_lists(lists: list[DataFrame]) -> DataFrame:
    """Distinct symbols of several lists, in first-seen order.

    Each list brings (symbol, pos). The result's ``pos`` ranks earlier lists first; it orders the rows
    without numbering them one by one, which would need all of them in a single task.
    """
    step = F.lit(LIST_STEP).cast("decimal(38,0)")
    parts = [
        d.select("symbol", (F.lit(i) * step + F.col("pos").cast("decimal(38,0)")).cast("decimal(38,0)").alias("pos"))
        for i, d in enumerate(lists)
    ]
    both = reduce(DataFrame.unionByName, parts)
    return both.filter(F.col("symbol").isNotNull()).groupBy("symbol").agg(F.min("pos").alias("pos"))
