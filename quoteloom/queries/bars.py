"""Queries over bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.operators.bars import (
    batch_bars,
    by_date_and_symbol,
    date_range,
    latest_bar,
    period,
    resample,
    wide_to_long,
)
from quoteloom.operators.coverage import latest_dates, status_counts, written_counts
from quoteloom.operators.dedup import keep_first, keep_last
from quoteloom.operators.info import with_attributes
from quoteloom.operators.trailing import average_volume, high_low, moving_averages, trading_snapshot
from quoteloom.operators.trailing_state import STATE, advance
from quoteloom.operators.universe import restrict
from quoteloom.plans.ticks import read_tick_bars, run_ticks
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query
from quoteloom.session import stage, work_path


@query("bars_from_ticks", "R1 M1", f"WITH {i.DAILY_SQL} SELECT * FROM daily")
def bars_from_ticks(spark, sf):
    return i.daily(spark, sf)


def _resample_sql(unit: str) -> str:
    return f"""WITH {i.PART_BARS_SQL}
    SELECT symbol, CAST(date_trunc('{unit}', date) AS DATE) AS date, arg_min(open, date) AS open,
           max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
           CAST(sum(volume) AS BIGINT) AS volume
    FROM part_bars GROUP BY symbol, date_trunc('{unit}', date)"""


@query("bars_weekly", "R2", _resample_sql("week"))
def bars_weekly(spark, sf):
    return i.part_bars_by(spark, sf, "week")


@query("bars_monthly", "R2", _resample_sql("month"))
def bars_monthly(spark, sf):
    return i.part_bars_by(spark, sf, "month")


@query(
    "bars_weekly_from_daily",
    "R2",
    _resample_sql("week").replace(i.PART_BARS_SQL, i.SUPPLIER_BARS_SQL).replace("FROM part_bars", "FROM supplier_bars"),
)
def bars_weekly_from_daily(spark, sf):
    return resample(i.supplier_bars(spark, sf), "week")


@query(
    "latest_bar",
    "R1 A3 J2 W2",
    f"""WITH {i.DAILY_SQL}
    SELECT * FROM daily
    WHERE symbol IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0)
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1""",
)
def latest(spark, sf):
    """Newest bar of each symbol of the universe; ticks of other symbols are dropped before grouping."""
    known = i.table(spark, sf, "customer").filter("c_acctbal >= 0").select(
        F.col("c_custkey").cast("string").alias("symbol")
    )
    return latest_bar(i.tick_bars(restrict(i.ticks(spark, sf), known)))


@query("latest_stored_date", "A3", f"WITH {i.PART_BARS_SQL} SELECT symbol, max(date) AS last_date FROM part_bars GROUP BY symbol")
def latest_stored_date(spark, sf):
    return latest_dates(i.line_ticks(spark, sf, "l_partkey").select(F.col("key").cast("string").alias("symbol"), "date"))


def _writer_sql(direction: str) -> str:
    return f"""SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
      l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS size
    FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                               ORDER BY l_orderkey {direction}, l_linenumber {direction}) = 1"""


def _lines(spark, sf):
    return i.line_ticks(spark, sf, "l_partkey")


def _symbol_first(df):
    return df.select(F.col("key").cast("string").alias("symbol"), "date", "price", "size")


@query("last_writer_wins", "W2 W3", _writer_sql("DESC"))
def last_writer_wins(spark, sf):
    return _symbol_first(keep_last(_lines(spark, sf), ["key", "date"], "line"))


@query("first_writer_wins", "W1", _writer_sql("ASC"))
def first_writer_wins(spark, sf):
    return _symbol_first(keep_first(_lines(spark, sf), ["key", "date"], "line"))


@query(
    "batch_bars_clean",
    "Q1 P7 W1 J3 O1",
    f"""WITH {i.TICKS_SQL}
    SELECT date, symbol, price AS close, size AS volume FROM ticks
    WHERE symbol NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)
      AND event_type <> 'error'
    QUALIFY row_number() OVER (PARTITION BY date, symbol ORDER BY ts, seq) = 1 ORDER BY date, symbol""",
)
def batch_bars_clean(spark, sf):
    """Landed rows, several per (date, symbol) and some without close, to the sorted batch table."""
    landed = i.ticks(spark, sf).select(
        "date", "symbol",
        F.when(F.col("event_type") != "error", F.col("price")).alias("close"),
        F.col("size").alias("volume"),
        i.tick_order().alias("pos"),
    )
    wanted = landed.join(i.known_rejects(spark, sf).select("symbol"), "symbol", "left_anti")
    return by_date_and_symbol(batch_bars(wanted, "pos").drop("pos"))


@query(
    "wide_to_long_bars",
    "S9 P7",
    f"""WITH {i.TICKS_SQL}
    SELECT date, event_type AS symbol, arg_min(price, row(ts, seq)) AS open, max(price) AS high,
           min(price) AS low, arg_max(price, row(ts, seq)) AS close, CAST(NULL AS DOUBLE) AS adj_close,
           CAST(sum(size) AS DOUBLE) AS volume
    FROM ticks GROUP BY date, event_type""",
)
def wide_to_long_bars(spark, sf):
    """Bars per event type are laid out as one wide frame, SYM:Field per column, and read back."""
    bars = i.tick_bars(i.ticks(spark, sf), ("event_type", "date"))
    fields = ["Open", "High", "Low", "Close", "Volume"]
    wide = bars.groupBy("date").pivot("event_type", i.EVENT_TYPES).agg(
        *[F.first(f.lower()).alias(f) for f in fields]
    )
    names = [c if c == "date" else ":".join(c.split("_", 1)) for c in wide.columns]
    return wide_to_long(wide.toDF(*names).withColumnRenamed("date", "Date"))


@query(
    "date_range_filter",
    "P10",
    f"WITH {i.PART_BARS_SQL} SELECT * FROM part_bars WHERE date >= DATE '1998-01-01' AND date < DATE '2000-01-01'",
)
def date_range_filter(spark, sf):
    return date_range(i.part_bars(spark, sf), "1998-01-01", "2000-01-01")


_PERIODS = {
    "1d": "(SELECT min(date) FROM (SELECT DISTINCT date FROM supplier_bars WHERE date <= DATE '2001-06-30' ORDER BY date DESC LIMIT 1))",
    "5d": "(SELECT min(date) FROM (SELECT DISTINCT date FROM supplier_bars WHERE date <= DATE '2001-06-30' ORDER BY date DESC LIMIT 5))",
    "1mo": "DATE '2001-05-30'",
    "3mo": "DATE '2001-03-30'",
    "6mo": "DATE '2000-12-30'",
    "1y": "DATE '2000-06-30'",
    "2y": "DATE '1999-06-30'",
    "5y": "DATE '1996-06-30'",
    "10y": "DATE '1991-06-30'",
    "ytd": "DATE '2001-01-01'",
    "max": "DATE '0001-01-01'",
}


def _add_period(text: str, since: str) -> None:
    @query(
        f"period_filter_{text}",
        "R6 P10",
        f"WITH {i.SUPPLIER_BARS_SQL} SELECT * FROM supplier_bars WHERE date <= DATE '2001-06-30' AND date >= {since}",
    )
    def build(spark, sf, text=text):
        return period(i.supplier_bars(spark, sf), text, "2001-06-30")


for _text, _since in _PERIODS.items():
    _add_period(_text, _since)


def _mean_sql(n: int) -> str:
    frame = f"OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"CAST(sum(CAST(close AS DECIMAL(24, 8))) {frame} AS DOUBLE)"
        f" / nullif(CAST(count(close) {frame} AS DOUBLE), 0) AS avg_{n}"
    )


@query(
    "moving_averages",
    "R3",
    f"WITH {i.SUPPLIER_BARS_SQL} SELECT symbol, date, close, {_mean_sql(50)}, {_mean_sql(200)} FROM supplier_bars",
)
def moving_averages_query(spark, sf):
    return moving_averages(i.supplier_bars(spark, sf))


@query(
    "high_low_52w",
    "R4",
    f"""WITH {i.SUPPLIER_BARS_SQL}
    SELECT symbol, date, max(high) OVER w AS high_52w, min(low) OVER w AS low_52w FROM supplier_bars
    WINDOW w AS (PARTITION BY symbol ORDER BY date RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW)""",
)
def high_low_52w(spark, sf):
    return high_low(i.supplier_bars(spark, sf))


@query(
    "avg_volume_10",
    "R5",
    f"""WITH {i.SUPPLIER_BARS_SQL}
    SELECT symbol, date, volume, CAST(sum(volume) OVER w AS DOUBLE) / CAST(count(*) OVER w AS DOUBLE) AS avg_volume_10
    FROM supplier_bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def avg_volume_10(spark, sf):
    return average_volume(i.supplier_bars(spark, sf))


_SNAPSHOT_SQL = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS r,
         max(date) OVER (PARTITION BY symbol) AS last, CAST(close AS DECIMAL(24, 8)) AS c
  FROM {bars}), snapshot AS (
  SELECT symbol, max(last) AS date,
         CAST(sum(c) FILTER (r <= 50) AS DOUBLE) / nullif(CAST(count(c) FILTER (r <= 50) AS DOUBLE), 0) AS "fiftyDayAverage",
         CAST(sum(c) FILTER (r <= 200) AS DOUBLE) / nullif(CAST(count(c) FILTER (r <= 200) AS DOUBLE), 0) AS "twoHundredDayAverage",
         max(high) FILTER (date > last - 365) AS "fiftyTwoWeekHigh",
         min(low) FILTER (date > last - 365) AS "fiftyTwoWeekLow",
         CAST(sum(volume) FILTER (r <= 10) AS DOUBLE) / nullif(CAST(count(volume) FILTER (r <= 10) AS DOUBLE), 0) AS "averageDailyVolume10Day"
  FROM ranked GROUP BY symbol)"""


# Bars without some volumes and closes, and with prices below a cent.
_GAPS_SQL = """gaps AS (
  SELECT symbol, date, high, low, CASE WHEN day(date) % 7 <> 3 THEN close / 65536 END AS close,
         CASE WHEN day(date) % 5 <> 2 THEN volume END AS volume
  FROM supplier_bars)"""


@query(
    "trailing_with_gaps",
    "R3 R4 R5",
    f"""WITH {i.SUPPLIER_BARS_SQL}, {_GAPS_SQL}, {_SNAPSHOT_SQL.format(bars='gaps')}, means AS (
      SELECT symbol, date, {_mean_sql(50)}, {_mean_sql(200)},
             CAST(sum(volume) OVER w AS DOUBLE) / nullif(CAST(count(volume) OVER w AS DOUBLE), 0) AS avg_volume_10
      FROM gaps WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    SELECT t.*, s."fiftyDayAverage", s."twoHundredDayAverage", s."averageDailyVolume10Day"
    FROM means t LEFT JOIN snapshot s ON t.symbol = s.symbol AND t.date = s.date""",
)
def trailing_with_gaps(spark, sf):
    bars = i.supplier_bars(spark, sf).select(
        "symbol", "date", "high", "low",
        F.when(F.dayofmonth("date") % 7 != 3, F.col("close") / 65536).alias("close"),
        F.when(F.dayofmonth("date") % 5 != 2, F.col("volume")).alias("volume"),
    )
    prices = moving_averages(bars).drop("close")
    volumes = average_volume(bars).drop("volume")
    newest = trading_snapshot(bars).drop("fiftyTwoWeekHigh", "fiftyTwoWeekLow")
    return prices.join(volumes, ["symbol", "date"]).join(newest, ["symbol", "date"], "left")


@query(
    "trading_snapshot",
    "R3 R4 R5 S12",
    f"WITH {i.SUPPLIER_BARS_SQL}, {_SNAPSHOT_SQL.format(bars='supplier_bars')} SELECT * FROM snapshot",
)
def trading_snapshot_query(spark, sf):
    return trading_snapshot(i.supplier_bars(spark, sf))


@query(
    "bars_with_attributes",
    "J6 P21 M2",
    f"""WITH {i.DAILY_SQL}
    SELECT d.*, CAST(c_acctbal AS DOUBLE) AS "marketCap", c_mktsegment AS sector, n_name AS industry
    FROM daily d LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey)
      ON d.symbol = CAST(c_custkey AS VARCHAR)""",
)
def bars_with_attributes(spark, sf):
    attributes = i.company_universe(spark, sf).select(
        "symbol", F.col("market_cap").alias("marketCap"), "sector", "industry"
    )
    return with_attributes(i.daily(spark, sf), attributes)


@query(
    "written_distinct_counts",
    "A2",
    f"WITH {i.DAILY_SQL} SELECT count(DISTINCT date) AS dates, count(DISTINCT symbol) AS symbols FROM daily",
)
def written_distinct_counts(spark, sf):
    """Bars and their ticks have the same dates and symbols, so the ticks are counted directly."""
    return written_counts(i.ticks(spark, sf))


@query(
    "run_status_counts",
    "A9",
    f"""WITH {i.TICKS_SQL}
    SELECT CASE WHEN event_type = 'error' THEN 'rejected' WHEN size > 50 THEN 'updated' ELSE 'skipped' END AS status,
           count(*) AS rows FROM ticks GROUP BY 1""",
)
def run_status_counts(spark, sf):
    status = (
        F.when(F.col("event_type") == "error", "rejected").when(F.col("size") > 50, "updated").otherwise("skipped")
    )
    return status_counts(i.ticks(spark, sf), status)


@query(
    "high_low_3y",
    "R4",
    f"""WITH {i.PART_BARS_SQL}
    SELECT symbol, date, max(high) OVER w AS high_52w, min(low) OVER w AS low_52w FROM part_bars
    WINDOW w AS (PARTITION BY symbol ORDER BY date RANGE BETWEEN INTERVAL 1094 DAY PRECEDING AND CURRENT ROW)""",
)
def high_low_3y(spark, sf):
    """Extrema of three years: a longer span costs the same."""
    return high_low(i.part_bars(spark, sf), 1095)


@query(
    "snapshot_of_two_sources",
    "R3 R4 R5",
    f"WITH {i.SUPPLIER_BARS_SQL}, {_SNAPSHOT_SQL.format(bars='supplier_bars')} SELECT * FROM snapshot",
)
def snapshot_of_two_sources(spark, sf):
    """Every bar stands there from two sources; the first source's count, once a day."""
    bars = i.supplier_bars(spark, sf)
    other = bars.withColumns({c: F.col(c) * 2 for c in ("open", "high", "low", "close")}).withColumn("source", F.lit("bulk"))
    return trading_snapshot(other.unionByName(bars.withColumn("source", F.lit("history"))))


@query(
    "trailing_increments",
    "R3 R5",
    f"""WITH {i.SUPPLIER_BARS_SQL} SELECT symbol, date, close, volume, {_mean_sql(50)}, {_mean_sql(200)},
      CAST(sum(volume) OVER w AS DOUBLE) / CAST(count(*) OVER w AS DOUBLE) AS avg_volume_10
    FROM supplier_bars WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
)
def trailing_increments(spark, sf):
    """All bars in three deliveries by date, and every ninth day of them late: the state gives what history would."""
    bars = stage(i.supplier_bars(spark, sf).select("symbol", "date", "close", "volume"), "bars")
    late = F.pmod(F.unix_date("date"), F.lit(9)) == 4
    cuts = [F.col("date") < "1994-01-01", (F.col("date") >= "1994-01-01") & (F.col("date") < "1997-01-01"), F.col("date") >= "1997-01-01"]
    state, values, before = spark.createDataFrame([], STATE), None, None
    for k, delivered in enumerate([bars.where(cut & ~late) for cut in cuts] + [bars.where(late)]):
        old = before if before is not None else bars.limit(0)
        now, state = advance(state, old, delivered)
        state, now = stage(state, "state"), now.withColumn("k", F.lit(k))
        values = now if values is None else values.unionByName(now)
        before = delivered if before is None else before.unionByName(delivered)
    return keep_last(values, ["symbol", "date"], "k").drop("k")


def _ticks_sql(unit: str) -> str:
    if unit == "day":
        return f"WITH {i.DAILY_SQL} SELECT * FROM daily"
    return f"""WITH {i.DAILY_SQL} SELECT symbol, CAST(date_trunc('{unit}', date) AS DATE) AS date, arg_min(open, date) AS open,
      max(high) AS high, min(low) AS low, arg_max(close, date) AS close, CAST(sum(volume) AS BIGINT) AS volume
    FROM daily GROUP BY symbol, date_trunc('{unit}', date)"""


def _add_deliveries(unit: str) -> None:
    @query(f"tick_deliveries_{unit}", "R1 R2 U1", _ticks_sql(unit))
    def build(spark, sf, unit=unit):
        """Ticks in three deliveries that cut through days, one of them run twice."""
        path = work_path(spark, "tick-bars")
        ticks = i.ticks(spark, sf).withColumn("k", F.pmod(F.col("seq"), F.lit(3)))
        for k in (2, 0, 1, 0):
            run_ticks(ticks.where(F.col("k") == k), path, f"delivery-{k}", "price", "size", i.tick_order())
        return read_tick_bars(spark, path, unit)


for _unit in ("day", "week", "month"):
    _add_deliveries(_unit)
