"""Queries that merge new rows into stored ones, and the bulk snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.dates import stored_day
from quoteloom.operators.bars import latest_bar
from quoteloom.operators.coverage import latest_dates
from quoteloom.operators.merge import (
    add_rejects,
    insert_only,
    last_suffix,
    restore_suffix,
    union_wide,
    upsert_new_wins,
    upsert_old_wins,
)
from quoteloom.plans.bulk import merge_bulk
from quoteloom.plans.history import request_starts, wanted
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query
from quoteloom.session import work_path
from quoteloom.sinks.tables import append_bars, as_bars, replace_dates, replace_dates_staged
from quoteloom.sources.bulk import bulk_rows, last_written
from quoteloom.sources.history import read_bars
from quoteloom.operators.dedup import keep_last
from quoteloom.streaming.bulk_stream import stream_bar_rows

# Stored bars end on the 20th and lack the error ticks; the delivery begins on the 15th and has all.
_OLD_NEW_SQL = i.TICKS_SQL + """, old AS (
  SELECT symbol, date, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, seq)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks WHERE date <= DATE '2024-01-20' AND event_type <> 'error' GROUP BY symbol, date), new AS (
  SELECT symbol, date, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, seq)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks WHERE date >= DATE '2024-01-15' GROUP BY symbol, date)"""


def _old_new(spark, sf) -> tuple[DataFrame, DataFrame]:
    ticks = i.ticks(spark, sf)
    old = ticks.filter("date <= DATE '2024-01-20' AND event_type <> 'error'")
    return i.tick_bars(old), i.tick_bars(ticks.filter("date >= DATE '2024-01-15'"))


@query(
    "history_upsert_new_wins",
    "U1",
    f"""WITH {_OLD_NEW_SQL}
    SELECT * FROM old WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM new) UNION ALL SELECT * FROM new""",
)
def history_upsert_new_wins(spark, sf):
    return upsert_new_wins(*_old_new(spark, sf))


@query(
    "bulk_upsert_old_wins",
    "U2 J5 T2",
    f"""WITH {_OLD_NEW_SQL}
    SELECT * FROM old UNION ALL SELECT * FROM new WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM old)""",
)
def bulk_upsert_old_wins(spark, sf):
    return upsert_old_wins(*_old_new(spark, sf))


@query(
    "bulk_new_bars",
    "J5 A9",
    f"WITH {_OLD_NEW_SQL} SELECT * FROM new WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM old)",
)
def bulk_new_bars(spark, sf):
    return insert_only(*_old_new(spark, sf))


@query(
    "history_incremental",
    "Q2 A3 P10 J2 B9 F8",
    f"""WITH {_OLD_NEW_SQL}, wanted AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer),
    starts AS (SELECT w.symbol, coalesce(max(date) + 1, DATE '2020-01-01') AS start
               FROM wanted w LEFT JOIN old ON w.symbol = old.symbol GROUP BY w.symbol),
    fresh AS (SELECT new.* FROM new JOIN starts USING (symbol) WHERE date >= start)
    SELECT * FROM old WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM fresh) UNION ALL SELECT * FROM fresh""",
)
def history_incremental(spark, sf):
    """Each symbol's delivery begins the day after its own newest stored bar."""
    old, new = _old_new(spark, sf)
    fresh = wanted(new, request_starts(i.requested(spark, sf), latest_dates(old), "1d"))
    return upsert_new_wins(old, fresh.select(*old.columns))


@query(
    "history_store_round_trip",
    "K1 K2 S6 O1",
    f"""WITH {_OLD_NEW_SQL}
    SELECT * FROM old WHERE (symbol, date) NOT IN (SELECT (symbol, date) FROM new) UNION ALL SELECT * FROM new""",
)
def history_store_round_trip(spark, sf):
    """The same merge through the stored table: only the delivered dates are read back and replaced."""
    old, new = _old_new(spark, sf)
    path = work_path(spark, "history")
    replace_dates(as_bars(old, "1d", "history"), path)
    new = as_bars(new, "1d", "history")
    stored = read_bars(spark, path, "1d")
    touched = stored.join(new.select("date").distinct(), "date", "left_semi")
    replace_dates_staged(upsert_new_wins(touched, new.select(*touched.columns)), path)
    return read_bars(spark, path, "1d").select("symbol", "date", "open", "high", "low", "close", "volume")


_BULK_TEXT = {
    "open": "CASE p_size WHEN 3 THEN 'N/A' WHEN 4 THEN NULL ELSE CAST(p_retailprice AS {text}) END",
    "high": "CASE p_size WHEN 5 THEN 'n/a' WHEN 6 THEN 'high' WHEN 7 THEN NULL ELSE CAST(p_retailprice + p_size AS {text}) END",
    "low": "CAST(p_retailprice - p_size AS {text})",
    "price": "CASE p_size WHEN 8 THEN '' ELSE CAST(p_retailprice + 1 AS {text}) END",
    "volume": "CASE p_size WHEN 9 THEN 'Infinity' WHEN 10 THEN '12.9' ELSE CAST(p_size * 1000 AS {text}) END",
}

_BULK_SQL = i.UNIVERSE_SQL + """, landed AS (
  SELECT p_partkey AS pos, """ + ", ".join(
    f"{expr.format(text='VARCHAR')} AS {name}_text" for name, expr in _BULK_TEXT.items()
) + """ FROM part), valid AS (
  SELECT DATE '2025-10-01' AS date, symbol, TRY_CAST(open_text AS DOUBLE) AS open, TRY_CAST(high_text AS DOUBLE) AS high,
         TRY_CAST(low_text AS DOUBLE) AS low, TRY_CAST(price_text AS DOUBLE) AS close,
         TRY_CAST(trunc(TRY_CAST(volume_text AS DOUBLE)) AS BIGINT) AS volume, pos
  FROM cleaned JOIN landed USING (pos)
  WHERE symbol IS NOT NULL AND TRY_CAST(open_text AS DOUBLE) IS NOT NULL AND TRY_CAST(price_text AS DOUBLE) IS NOT NULL
    AND TRY_CAST(trunc(TRY_CAST(volume_text AS DOUBLE)) AS BIGINT) IS NOT NULL
    AND (high_text IS NULL OR high_text = 'n/a' OR TRY_CAST(high_text AS DOUBLE) IS NOT NULL))"""


def _snapshot(spark, sf) -> DataFrame:
    """Parts as the text rows of one bulk file, with the odd values such files have."""
    text = {name: F.expr(expr.format(text="STRING")) for name, expr in _BULK_TEXT.items()}
    return i.table(spark, sf, "part").select(
        F.expr(i._RAW_SYMBOL).alias("Symbol"),
        text["high"].alias("High 1 day"), text["low"].alias("Low 1 day"), text["open"].alias("Open 1 day"),
        text["price"].alias("Price"), text["volume"].alias("Volume 1 day"),
        F.lit("2025-10-01").cast("date").alias("date"),
        F.lit(0).alias("file_no"),
        F.col("p_partkey").cast("decimal(24,0)").alias("row_order"),
    )


@query(
    "bulk_rows_valid",
    "P1d P3 P4 P5 P6 F10 F11 B6",
    f"WITH {_BULK_SQL} SELECT * FROM valid",
)
def bulk_rows_valid(spark, sf):
    return bulk_rows(_snapshot(spark, sf)).select(
        "date", "symbol", "open", "high", "low", "close", "volume", F.col("row_order").cast("bigint").alias("pos")
    )


_LAST_SQL = """last AS (
  SELECT date, symbol, open, high, low, close, volume FROM valid
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos DESC) = 1)"""


@query(
    "bulk_snapshot_merge",
    "Q3 W3 J2 J5 U2",
    f"""WITH {_BULK_SQL}, {_LAST_SQL},
    stored AS (SELECT symbol FROM universe WHERE exchange = 'NYSE'),
    wanted AS (SELECT symbol FROM universe WHERE sector <> 'ECONOMY')
    SELECT * FROM last WHERE symbol IN (SELECT symbol FROM wanted) AND symbol NOT IN (SELECT symbol FROM stored)""",
)
def bulk_snapshot_merge(spark, sf):
    """Bars a snapshot adds to a store that already has the NYSE symbols of that day."""
    universe = i.universe(spark, sf)
    stored = universe.filter("exchange = 'NYSE'").select("symbol", F.lit("2025-10-01").cast("date").alias("date"))
    symbols = universe.filter("sector <> 'ECONOMY'").select("symbol")
    bars = merge_bulk(bulk_rows(_snapshot(spark, sf)), stored, symbols)
    return bars.select("date", "symbol", "open", "high", "low", "close", "volume")


@query(
    "bulk_backfill",
    "Q11 W3 U2",
    """SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
      l_extendedprice AS close, CAST(l_quantity AS BIGINT) AS volume FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
      ORDER BY l_returnflag DESC, l_orderkey DESC, l_linenumber DESC) = 1""",
)
def bulk_backfill(spark, sf):
    """Many dated files at once: the last row of the last file wins for each symbol and day."""
    rows = i.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("symbol"), i.day("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("close"), F.col("l_quantity").cast("bigint").alias("volume"),
        F.ascii("l_returnflag").alias("file_no"),
        (F.col("l_orderkey") * F.lit(100) + F.col("l_linenumber")).cast("decimal(24,0)").alias("row_order"),
    )
    return last_written(rows).withColumn("symbol", F.col("symbol").cast("string"))


@query(
    "bulk_stream_merge",
    "T1 T2 U2 K3",
    f"""WITH {i.TICKS_SQL}
    SELECT symbol, date, price AS close, size AS volume FROM ticks
    QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY ts DESC, seq DESC) = 1""",
)
def bulk_stream_merge(spark, sf):
    """The events as a stream of files, merged file by file into a stored table."""
    path = work_path(spark, "stream")
    events = i.table(spark, sf, "events")
    events.repartition(3, "event_id").write.parquet(f"{path}/events")
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")

    def to_rows(batch: DataFrame) -> DataFrame:
        ticks = batch.select(
            F.col("user_id").cast("string").alias("symbol"), i.day("ts").alias("date"),
            F.col("value").alias("close"),
            F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("bigint").alias("volume"),
            F.lit("").alias("file_name"),
            i.order_key(F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")).alias("row_order"),
        )
        return keep_last(ticks, ["symbol", "date"], "row_order")

    stream_bar_rows(rows, to_rows, f"{path}/bars", f"{path}/checkpoint").awaitTermination()
    return read_bars(spark, f"{path}/bars", "1d").select("symbol", "date", "close", "volume")


_STORED_SQL = i.TICKS_SQL + """, stored AS (
  SELECT symbol, seq AS pos, price, concat(strftime(date, '%Y-%m-%d'), ' 00:00:00', suffix) AS date_text FROM (
    SELECT *, CASE event_type WHEN 'click' THEN '-04:00' WHEN 'view' THEN '-05:00' WHEN 'purchase' THEN '+01:00'
                   ELSE '' END AS suffix FROM ticks))"""


def _stored_text(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    suffix = (
        F.when(kind == "click", "-04:00").when(kind == "view", "-05:00").when(kind == "purchase", "+01:00").otherwise("")
    )
    return i.ticks(spark, sf).select(
        "symbol", F.col("seq").alias("pos"), "price",
        F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 00:00:00"), suffix).alias("date_text"),
    )


@query(
    "tz_suffix_restore",
    "W6 F7 F6",
    f"""WITH {_STORED_SQL}, {i.DAILY_SQL.split('), daily AS', 1)[1].join(['daily AS', ''])}, suffixes AS (
      SELECT symbol, coalesce(nullif(regexp_extract(arg_max(date_text, pos), '([+-][0-9]{{2}}:[0-9]{{2}})$', 1), ''), '-05:00') AS suffix
      FROM stored GROUP BY symbol), newest AS (
      SELECT symbol, date, close FROM daily QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)
    SELECT symbol, date, close, concat(strftime(date, '%Y-%m-%d'), ' 00:00:00', coalesce(suffix, '-05:00')) AS date_text
    FROM newest LEFT JOIN suffixes USING (symbol)""",
)
def tz_suffix_restore(spark, sf):
    newest = latest_bar(i.daily(spark, sf)).select("symbol", "date", "close")
    return restore_suffix(newest, last_suffix(_stored_text(spark, sf)))


@query(
    "stored_days",
    "S7 F9 B5",
    f"""WITH {_STORED_SQL}
    SELECT symbol, CAST(substr(date_text, 1, 10) AS DATE) AS date, count(*) AS rows,
           count(DISTINCT date_text) AS spellings FROM stored GROUP BY ALL""",
)
def stored_days(spark, sf):
    """Rows per calendar day, however many zone suffixes the day was stored with."""
    return (
        _stored_text(spark, sf)
        .groupBy("symbol", stored_day(F.col("date_text")).alias("date"))
        .agg(F.count("*").alias("rows"), F.countDistinct("date_text").alias("spellings"))
    )


@query(
    "rejects_update",
    "U4 P22 M11",
    f"""WITH {i.CUSTOMER_SQL}, fresh AS (
      SELECT symbol, DATE '2001-08-01' AS first_seen FROM requested WHERE symbol NOT IN (SELECT symbol FROM delivered))
    SELECT symbol, min(first_seen) AS first_seen FROM (SELECT * FROM known_rejects UNION ALL SELECT * FROM fresh) GROUP BY symbol""",
)
def rejects_update(spark, sf):
    new = i.requested(spark, sf).join(i.delivered(spark, sf).select("symbol"), "symbol", "left_anti")
    return add_rejects(i.known_rejects(spark, sf), new.withColumn("first_seen", F.lit("2001-08-01").cast("date")))


@query(
    "union_of_wide_frames",
    "U6",
    f"""WITH {i.CUSTOMER_SQL}
    SELECT symbol, sector, industry, CAST(NULL AS DATE) AS date FROM info
    UNION ALL SELECT symbol, NULL, NULL, date FROM stored""",
)
def union_of_wide_frames(spark, sf):
    info = i.company_universe(spark, sf).select("symbol", "sector", "industry")
    return union_wide([info, i.stored_orders(spark, sf)])
