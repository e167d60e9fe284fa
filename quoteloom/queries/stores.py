"""Queries over numbered lists, bitmaps of members, and streams with event time."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.functions.choices import FLAG_NAMES
from quoteloom.operators.bitmaps import bit_counts, bit_members, choice_bitmaps, key_bitmaps, symbol_numbers
from quoteloom.operators.numbering import dense_positions
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query
from quoteloom.session import work_path
from quoteloom.streaming.tick_stream import as_ticks, closed_bars, late_ticks, open_bars, run_tick_stream


@query(
    "line_positions",
    "O3 U5 K11",
    """SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber) AS pos
    FROM lineitem""",
)
def line_positions(spark, sf):
    """Every line numbered by day; a third of the lines may share one."""
    lines = i.table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_linenumber")
    return dense_positions(lines, ["l_shipdate", "l_orderkey", "l_linenumber"]).drop("l_shipdate")


@query(
    "index_counts_bitmap",
    "A1 A6",
    f"WITH {i.MEMBERSHIP_SQL} SELECT index_key, count(*) AS members FROM membership GROUP BY index_key "
    "UNION ALL SELECT '', count(*) FROM universe",
)
def index_counts_bitmap(spark, sf):
    universe = i.universe(spark, sf).select("symbol", "indexes")
    return bit_counts(key_bitmaps(universe, symbol_numbers(universe)), "index_key")


def _choices_sql(columns: str) -> str:
    parts = []
    for choice, flags in FLAG_NAMES.items():
        listed = ", ".join(f"'{f}'" for f in flags)
        wanted = f"WHERE symbol IN (SELECT symbol FROM membership WHERE index_key IN ({listed}))" if flags else ""
        parts.append(f"SELECT {choice} AS choice, {columns} FROM universe {wanted}")
    return f"WITH {i.MEMBERSHIP_SQL} " + " UNION ALL ".join(parts)


@query("choice_counts_bitmap", "P11 P12 A1", f"SELECT * FROM ({_choices_sql('count(*) AS members')}) WHERE members > 0")
def choice_counts_bitmap(spark, sf):
    universe = i.universe(spark, sf).select("symbol", "indexes")
    return bit_counts(choice_bitmaps(key_bitmaps(universe, symbol_numbers(universe))), "choice")


@query("choice_members_bitmap", "P11 P12 Q5", _choices_sql("symbol"))
def choice_members_bitmap(spark, sf):
    universe = i.universe(spark, sf).select("symbol", "indexes")
    numbers = symbol_numbers(universe)
    return bit_members(choice_bitmaps(key_bitmaps(universe, numbers)), numbers)




@query(
    "tick_stream_late",
    "T1 T2 R1",
    f"""WITH {i.TICKS_SQL}, bounds AS (SELECT min(ts) + (max(ts) - min(ts)) / 3 AS one, min(ts) + (max(ts) - min(ts)) / 3 * 2 AS two FROM ticks),
    arrived AS (
      SELECT ticks.*, (CASE WHEN ts < one THEN 0 WHEN ts < two THEN 1 ELSE 2 END)
        + CASE WHEN seq % 49 = 3 THEN 2 WHEN seq % 7 = 3 THEN 1 ELSE 0 END AS arrival FROM ticks, bounds),
    marks AS (SELECT a.arrival, (SELECT max(b.ts) - INTERVAL 1 DAY FROM arrived b WHERE b.arrival < a.arrival) AS mark
      FROM (SELECT DISTINCT arrival FROM arrived) a),
    judged AS (
      SELECT arrived.*, coalesce(CAST(date AS TIMESTAMP) + INTERVAL 1 DAY <= mark, FALSE) AS late FROM arrived JOIN marks USING (arrival))
    SELECT symbol, date, arg_min(price, row(ts, seq)) FILTER (NOT late) AS open, max(price) FILTER (NOT late) AS high,
      min(price) FILTER (NOT late) AS low, arg_max(price, row(ts, seq)) FILTER (NOT late) AS close,
      CAST(sum(size) FILTER (NOT late) AS BIGINT) AS volume, count(*) FILTER (NOT late) AS n_ticks, count(*) FILTER (late) AS n_late
    FROM judged GROUP BY symbol, date""",
)
def tick_stream_late(spark, sf):
    """Five arrivals as a file stream that is started anew for each; bars and late ticks account for every tick."""
    path = work_path(spark, "tick-stream")
    ticks = i.ticks(spark, sf)
    third = (F.max("us") - F.min("us")) / 3
    us = ticks.select(F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    one, two = us.agg((F.min("us") + third).alias("one"), (F.min("us") + third * 2).alias("two")).first()
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    arrival = F.when(at < one, 0).when(at < two, 1).otherwise(2)
    arrival = arrival + F.when(F.col("seq") % 49 == 3, 2).when(F.col("seq") % 7 == 3, 1).otherwise(0)
    sent = as_ticks(ticks, "price", "size", i.tick_order()).schema
    for k in range(5):
        now = as_ticks(ticks.where(arrival == k), "price", "size", i.tick_order())
        now.write.mode("append").parquet(f"{path}/landed")
        arriving = spark.readStream.schema(sent).parquet(f"{path}/landed")
        run_tick_stream(arriving, f"{path}/store", "1 day")
    bars = closed_bars(spark, f"{path}/store").unionByName(open_bars(spark, f"{path}/store"))
    late = late_ticks(spark, f"{path}/store").groupBy("symbol", F.to_date("ts").alias("date")).agg(F.count("*").alias("n_late"))
    both = bars.join(late, ["symbol", "date"], "full")
    return both.withColumns({c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("n_ticks", "n_late")})
