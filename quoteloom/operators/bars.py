"""Making bars: from ticks, from wide frames, from finer bars, and cutting them by date."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.dates import parse_period
from quoteloom.functions.text import missing
from quoteloom.operators.dedup import keep_first

# Field names of a landed wide frame and the bar columns they become.
WIDE_FIELDS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
}


def bars_from_ticks(ticks: DataFrame, keys: list[str], price: str, size: str, order: Column) -> DataFrame:
    """open/high/low/close/volume per key; ``order`` ranks the ticks inside a key.

    With a fixed-width ``order`` (see ``order_key``) this is one hash aggregate with map-side combine.
    """
    p = F.col(price)
    return ticks.groupBy(*keys).agg(
        F.min_by(p, order).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, order).alias("close"),
        F.sum(size).cast("bigint").alias("volume"),
    )


def bars_of_label(ticks: DataFrame, keys: list[str], unit: str, price: str, size: str, line: Column) -> DataFrame:
    """R2 straight from ticks: one grouping by (key, label), which is ``resample`` over their daily bars.

    ``line`` ranks the ticks of a day, by whole numbers below 10**33. Days hardly repeat in a symbol's ticks, so
    grouping by day first would only shuffle nearly all rows once more.
    """
    if unit not in ("week", "month"):
        raise ValueError(f"unit must be week or month, not {unit!r}")
    step = F.lit("1" + "0" * 33).cast("decimal(34,0)")
    day = (F.unix_date("date").cast("decimal(5,0)") * step).cast("decimal(38,0)")
    order = (day + line.cast("decimal(38,0)")).cast("decimal(38,0)")
    label = F.date_trunc(unit, F.col("date")).cast("date")
    ticks = ticks.select(*keys, label.alias("date"), price, size, order.alias("_order"))
    return bars_from_ticks(ticks, [*keys, "date"], price, size, F.col("_order"))


def resample(bars: DataFrame, unit: str) -> DataFrame:
    """R2: weekly (label Monday) or monthly (label first day) bars from daily ones."""
    if unit not in ("week", "month"):
        raise ValueError(f"unit must be week or month, not {unit!r}")
    label = F.date_trunc(unit, F.col("date")).cast("date")
    aggs = [
        F.min_by("open", "date").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "date").alias("close"),
    ]
    if "adj_close" in bars.columns:
        aggs.append(F.max_by("adj_close", "date").alias("adj_close"))
    aggs.append(F.sum("volume").cast("bigint").alias("volume"))
    return bars.groupBy("symbol", label.alias("date")).agg(*aggs)


# Fields that landed frames may have besides those of a bar.
OTHER_FIELDS = frozenset(["Dividends", "Stock Splits", "Capital Gains", "Repaired?"])


def _split_name(name: str, sep: str) -> tuple[str, str] | None:
    """(symbol, field) of a column named ``SYM:Field`` or ``Field:SYM``; the symbol may hold the separator too."""
    fields = OTHER_FIELDS.union(WIDE_FIELDS)
    if sep not in name:
        return None
    left, _, right = name.rpartition(sep)
    if right in fields:
        return left, right
    left, _, right = name.partition(sep)
    if left in fields:
        return right, left
    raise ValueError(f"column {name!r} names no known field")


def wide_to_long(
    wide: DataFrame, date_col: str = "Date", sep: str = ":", symbol: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """One landed frame with symbol and field in the column names to one bar per row.

    The symbols are known from the column names, so each row is turned into an array of bars and
    inlined: no pivot and no shuffle. There is one array of names and one of values for each field, whatever the
    number of symbols; the column names go into them as one text each, so thousands of symbols plan in seconds.
    A frame of plain field columns belongs to the one ``symbol``. Bars without Close are dropped. Columns in ``keep``
    stay on every bar of their row.
    """
    keep = keep or []
    found: dict[str, dict[str, str]] = {}
    for name in wide.columns:
        if name == date_col or name in keep:
            continue
        parts = _split_name(name, sep)
        if parts:
            found.setdefault(parts[0], {})[parts[1]] = name
        elif symbol is not None and name in WIDE_FIELDS:
            found.setdefault(symbol, {})[name] = name
    if not found:
        raise ValueError("no column names of the form SYM:Field or Field:SYM")

    values = {}
    for field, out in WIDE_FIELDS.items():
        names = [fields.get(field) for fields in found.values()]
        values[out] = F.expr(f"array({', '.join(map(_quoted, names))})" if any(names) else f"array_repeat(CAST(NULL AS DOUBLE), {len(names)})")
    kept = [_quoted(c) for c in keep]
    rows = wide.select(*kept, F.col(_quoted(date_col)).cast("date").alias("date"), _texts(list(found)).alias("symbol"), *[v.alias(c) for c, v in values.items()])
    rows = rows.select(*kept, "date", "symbol", *[F.col(c).cast("array<double>").alias(c) for c in values])
    return drop_without_close(rows.select(*kept, "date", F.inline(F.arrays_zip("symbol", *values))))


def long_to_frames(bars: DataFrame, symbols: DataFrame, width: int = 100) -> DataFrame:
    """Bars as wide frames of ``width`` symbols each, all in one table: ``frame``, ``Date`` and a column for each place and field.

    ``symbols`` has ``symbol`` and its position ``pos`` from 1; position ``p`` is place ``(p - 1) % width`` of frame
    ``(p - 1) div width``, and its columns are ``<place>:<Field>``. So the columns, and with them the plan, are as many
    for any number of symbols, and more symbols are more rows. A date and frame without a bar has no row.
    """
    at = F.col("pos") - 1
    placed = symbols.select("symbol", F.floor(at / width).cast("bigint").alias("frame"), (at % width).cast("int").alias("place"))
    fields = {field: c for field, c in WIDE_FIELDS.items() if c in bars.columns}
    cell = F.struct("place", *[F.col(c).cast("double").alias(c) for c in fields.values()])
    rows = bars.join(placed, "symbol").groupBy("frame", F.col("date").alias("Date")).agg(F.collect_list(cell).alias("cells"))
    rows = rows.select("frame", "Date", *[F.col("cells")[c].alias(c) for c in ("place", *fields.values())])
    names = {f"{k}:{field}": (k, c) for k in range(width) for field, c in fields.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("place")
            place = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())
            columns = {}
            for c in fields.values():
                found = batch.column(c).flatten()
                value, none = np.zeros((width, len(batch))), np.ones((width, len(batch)), dtype=bool)
                value[place, row] = found.fill_null(0).to_numpy()
                none[place, row] = found.is_null().to_numpy(zero_copy_only=False)
                columns[c] = [pa.array(value[k], mask=none[k]) for k in range(width)]
            arrays = [batch.column("frame"), batch.column("Date"), *[columns[c][k] for k, c in names.values()]]
            yield pa.RecordBatch.from_arrays(arrays, ["frame", "Date", *names])

    kinds = ", ".join(f"`{n}` double" for n in names)
    return rows.mapInArrow(run, f"frame long, Date date, {kinds}")


def frames_to_long(frames: DataFrame, symbols: DataFrame, width: int = 100) -> DataFrame:
    """Frames as :func:`long_to_frames` makes them, to one bar per row."""
    places = wide_to_long(frames, keep=["frame"]).withColumnRenamed("symbol", "place")
    at = (F.col("frame") * width + F.col("place").cast("int") + 1).alias("pos")
    return places.select("*", at).join(symbols.select("symbol", "pos"), "pos").select("date", "symbol", *WIDE_FIELDS.values())


def _quoted(name: str | None) -> str:
    return "NULL" if name is None else f"`{name.replace('`', '``')}`"


def _texts(values: list[str]) -> Column:
    """An array of texts: one literal that is split at line breaks, unless a text has one."""
    if any("\n" in v for v in values):
        return F.array(*[F.lit(v) for v in values])
    return F.split(F.lit("\n".join(values)), "\n", -1)


def drop_without_close(bars: DataFrame) -> DataFrame:
    """P7."""
    return bars.filter(~missing(F.col("close")))


def date_range(bars: DataFrame, start: str | date | None, end: str | date | None) -> DataFrame:
    """P10: start <= date < end, as literals, so that the scan prunes partitions and row groups."""
    out = bars
    if start is not None:
        out = out.filter(F.col("date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        out = out.filter(F.col("date") < F.lit(str(end)).cast("date"))
    return out


def period(bars: DataFrame, text: str, as_of: str | date | Column) -> DataFrame:
    """The trailing period up to and including ``as_of``.

    ``nd`` is the last n distinct dates present; months and years are calendar spans; ``ytd`` starts
    on 1 January. The n-th last date is an uncorrelated scalar subquery over the date column alone.
    """
    unit, n = parse_period(text)
    last = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    upto = bars.filter(F.col("date") <= last)
    if unit == "max":
        return upto
    if unit == "ytd":
        return upto.filter(F.col("date") >= F.trunc(last, "year"))
    if unit == "mo":
        return upto.filter(F.col("date") >= F.add_months(last, -n))
    if unit == "y":
        return upto.filter(F.col("date") >= F.add_months(last, -12 * n))
    newest = upto.select("date").distinct().orderBy(F.desc("date")).limit(n)
    return upto.filter(F.col("date") >= newest.agg(F.min("date")).scalar())


def select_dates(bars: DataFrame, start, end, period_text: str, as_of) -> DataFrame:
    """A start date wins over the period."""
    return date_range(bars, start, end) if start is not None else period(bars, period_text, as_of)


def batch_bars(landed: DataFrame, order, keys: list[str] | None = None) -> DataFrame:
    """Landed long bars to one row per (date, symbol), the first landed one."""
    return keep_first(drop_without_close(landed), keys or ["date", "symbol"], order)


def by_date_and_symbol(bars: DataFrame) -> DataFrame:
    """O1."""
    return bars.orderBy("date", "symbol")


def latest_bar(bars: DataFrame) -> DataFrame:
    """Newest bar per symbol; needs one bar per (symbol, date)."""
    rest = [c for c in bars.columns if c not in ("symbol", "date")]
    return bars.groupBy("symbol").agg(
        F.max("date").alias("date"), *[F.max_by(c, "date").alias(c) for c in rest]
    )
