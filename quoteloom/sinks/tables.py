"""Writers (K1-K12). Each replaces or appends whole partitions, so a repeated run gives the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from quoteloom.operators.dedup import as_order
from quoteloom.schemas import BARS, REJECTS
from quoteloom.session import remove, stage
from quoteloom.sources.files import versions

# Bars of one source never replace those of another.
BAR_PARTITIONS = ["interval", "source", "date"]
# Rows of one date that a task of ``replace_dates_by_first`` takes; a date with more is dealt to several by symbol.
ROWS_A_PART = 2_000_000


def _spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows gathered by partition value; AQE splits large values and joins small ones together.

    A date that holds a third of all rows is written by many tasks, many tiny dates by one.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def ordered_by_partition(bars: DataFrame) -> DataFrame:
    return _spread(bars, BAR_PARTITIONS).sortWithinPartitions(*BAR_PARTITIONS, "symbol")


def as_bars(df: DataFrame, interval: str, source: str) -> DataFrame:
    """M1: the full bar schema; columns the source lacks are NULL."""
    given = {"interval": F.lit(interval), "source": F.lit(source)}
    columns = []
    for field in BARS.split(","):
        name, kind = field.split()
        value = given.get(name) if name in given else (F.col(name) if name in df.columns else F.lit(None))
        columns.append(value.cast(kind).alias(name))
    return df.select(*columns)


def replace_dates(bars: DataFrame, path: str) -> None:
    """K1, O1: every date in ``bars`` is replaced as a whole, sorted by symbol; other dates and sources stay."""
    (
        ordered_by_partition(bars)
        .write.partitionBy(*BAR_PARTITIONS)
        .mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def replace_dates_of(bars: DataFrame, path: str, interval: str, source: str) -> None:
    """K1, O1: as :func:`replace_dates` for bars of one interval and source, in whose folder only dates are told apart."""
    dates = bars.drop("interval", "source").hint("rebalance", F.col("date")).sortWithinPartitions("date", "symbol")
    (
        dates.write.partitionBy("date").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .parquet(f"{path}/interval={interval}/source={source}")
    )


def replace_dates_by_first(rows: DataFrame, path: str, interval: str, source: str, order, sizes: DataFrame | None = None) -> int:
    """As :func:`replace_dates_of` for the first row of each date and symbol in ``order``; gives the number of dates.

    Rows are shuffled once, by date, and the sort that the files need brings the rows of a key together as well.
    ``sizes`` has at least the rows of each date, when these are quicker to count than ``rows`` themselves. The dates
    are gathered as a set, which the calendar bounds.
    """
    sizes = rows if sizes is None else sizes
    parts = sizes.groupBy("date").agg(F.ceil(F.count("*") / ROWS_A_PART).alias("_parts")).where("_parts > 1")
    part = F.pmod(F.xxhash64("symbol"), F.coalesce("_parts", F.lit(1)))
    dealt = rows.join(F.broadcast(parts), "date", "left").withColumn("_part", part).repartition("date", "_part")
    key = Window.partitionBy("date", "symbol", "_part").orderBy(as_order(order))
    first = dealt.withColumn("_nth", F.row_number().over(key)).where("_nth = 1")
    seen = Observation()
    (
        as_bars(first, interval, source).drop("interval", "source")
        .observe(seen, F.size(F.collect_set("date")).alias("dates"))
        .write.partitionBy("date").mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .parquet(f"{path}/interval={interval}/source={source}")
    )
    return seen.get.get("dates") or 0


def replace_dates_staged(bars: DataFrame, path: str) -> None:
    """K2: as :func:`replace_dates` for rows computed from the same table.

    The rows are first written to the shared folder: the old dates are only dropped when the new ones
    exist in full, and a lost executor never recomputes from a half-replaced table.
    """
    replace_dates(stage(bars, "bars"), path)


def append_bars(bars: DataFrame, path: str) -> None:
    """K3: add rows to the partitions they belong to."""
    ordered_by_partition(bars).write.partitionBy(*BAR_PARTITIONS).mode("append").parquet(path)


def _replace_value(df: DataFrame, path: str, column: str, value: int | str) -> None:
    """One partition value is replaced, also by no rows at all."""
    df.write.mode("overwrite").parquet(f"{path}/{column}={value}")


def write_choice(universe: DataFrame, choice: int | str, path: str, rich: bool = True) -> None:
    """Symbols, info and clean info of one choice, one partition value per choice.

    Info is the full row, or the symbol only when the choice is made of symbol lists.
    """
    kept = stage(universe, "choice")
    names = [c for c in ("symbol", "pos") if c in kept.columns]
    rows = kept if rich else kept.select(*names)
    _replace_value(kept.select(*names), f"{path}/symbols", "choice", choice)
    _replace_value(rows, f"{path}/info", "choice", choice)
    _replace_value(rows, f"{path}/info_clean", "choice", choice)


def write_flag_table(flags: DataFrame, path: str) -> None:
    """K5: the sorted flag table; a full replacement."""
    flags.write.mode("overwrite").parquet(path)


def write_index_lists(members: DataFrame, path: str) -> None:
    """K6: one partition per index that has members; a full replacement."""
    (
        _spread(members, ["index_key"])
        .write.partitionBy("index_key")
        .mode("overwrite").option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def write_fundamentals(table: DataFrame, summary: DataFrame, path: str) -> None:
    """K7."""
    table.write.mode("overwrite").parquet(f"{path}/full")
    summary.write.mode("overwrite").parquet(f"{path}/summary")


def replace_rejects(rejects: DataFrame, path: str, source: str, interval: str) -> None:
    """K8 for history and bulk: the list of this run replaces that of (source, interval), also by nothing."""
    names = [f.split()[0] for f in REJECTS.split(",")]
    rows = rejects.select(*[n for n in names if n not in ("source", "interval")])
    rows.write.mode("overwrite").parquet(f"{path}/source={source}/interval={interval}")


def replace_table(df: DataFrame, path: str) -> None:
    """K9: a whole derived table, which the next run makes anew from other tables."""
    stage(df, "table").write.mode("overwrite").parquet(path)


def replace_state(df: DataFrame, path: str) -> None:
    """K8 for batch, K10: a whole table that is computed from itself.

    The rows become the next version of the table; ``read_table`` takes the newest complete one. The one before
    stays until the next run, so a crash at any point leaves a whole table.
    """
    spark = df.sparkSession
    kept = versions(spark, path)
    df.write.mode("overwrite").parquet(f"{path}/version={max(kept, default=0) + 1}")
    for old in kept[:-1]:
        remove(spark, f"{path}/version={old}")


def write_series(series: DataFrame, path: str) -> None:
    """Sorted by date; a new version, as it is computed from itself. AQE makes a short series one file."""
    replace_state(series.orderBy("date"), path)


def write_lists(lists: DataFrame, path: str) -> None:
    """Symbol lists, one partition per group, in the order of ``pos``; a full replacement."""
    ordered = _spread(lists, ["group"]).sortWithinPartitions("group", "pos")
    ordered.write.partitionBy("group").mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_info(info: DataFrame, choice: int | str, path: str) -> None:
    """Info rows of one choice."""
    _replace_value(info, path, "choice", choice)


def write_history_buckets(bars: DataFrame, table: str, path: str, buckets: int) -> None:
    """K2, K3: the history of each symbol kept together, as a table of ``buckets`` buckets by symbol.

    Windows, aggregates and joins by symbol over this table read it without a shuffle. Meant for one
    interval and rebuilt from the date partitions; a full replacement.
    """
    (
        bars.repartition(buckets, "symbol").write.mode("overwrite").format("parquet")
        .option("path", path).bucketBy(buckets, "symbol").sortBy("symbol", "date").saveAsTable(table)
    )


def export_csv(df: DataFrame, path: str, partitions: list[str] | None = None) -> None:
    """CSV with a header line for programs that read text, such as one folder per interval and date."""
    spread = _spread(df, partitions) if partitions else df
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "static").option("header", True)
    writer.partitionBy(*(partitions or [])).csv(path)
