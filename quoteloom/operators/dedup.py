"""One row per key: first, last, or last writer.

All of them are ``min_by``/``max_by`` aggregates rather than row numbers: Spark combines on the map
side first, so a key with a third of all rows reaches its reducer as one row per map task.
``order`` must be a total order inside a key and must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_order(order: str | Column | list) -> Column:
    if isinstance(order, (list, tuple)):
        return F.struct(*order)
    return F.col(order) if isinstance(order, str) else order


# Spark updates these in place in a hash aggregate's buffer; any other type means a sort aggregate.
_FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _pick(df: DataFrame, keys: list[str], order, pick) -> DataFrame:
    by = as_order(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    types = [f.dataType for f in df.select(*[f"`{c}`" for c in rest], by).schema.fields]
    grouped = df.groupBy(*[f"`{k}`" for k in keys])
    if all(isinstance(t, _FIXED_WIDTH) for t in types):
        picked = grouped.agg(*[pick(F.col(f"`{c}`"), by).alias(c) for c in rest])
    else:
        row = F.struct(*[F.col(f"`{c}`") for c in rest])
        picked = grouped.agg(pick(row, by).alias("_row"))
        picked = picked.select(*[f"`{k}`" for k in keys], *[F.col(f"_row.`{c}`").alias(c) for c in rest])
    return picked.select(*[f"`{c}`" for c in df.columns])


def keep_first(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The first row of each key in ``order``."""
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order) -> DataFrame:
    """The last row of each key in ``order``; order by (file name, row) for last writer wins."""
    return _pick(df, keys, order, F.max_by)
