"""Whole jobs and readers: a given table is landed as files or state, the real job runs, its stored table comes back.

Everything is written below the work folder.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.plans.batch import BATCH_REJECTS, run_batch
from quoteloom.plans.bulk import run_backfill
from quoteloom.plans.history import run_history
from quoteloom.plans.ratio import run_ratio
from quoteloom.plans.universe import run_choice, run_universe
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query
from quoteloom.session import glob, rename, work_path
from quoteloom.sources.files import columns_of, field, list_files, read_csv, read_table
from quoteloom.sources.history import read_bars, read_history_folder
from quoteloom.schemas import RATIO_SERIES, REJECTS


def land_csv(df: DataFrame, folder: str, name: str) -> None:
    """Rows as CSV files in ``folder``; every file that Spark writes gets ``name`` with its number in it."""
    spark = df.sparkSession
    path = work_path(spark, "landing")
    df.write.option("header", True).csv(path)
    for k, part in enumerate(glob(spark, f"{path}/part-*")):
        rename(spark, part, f"{folder}/{name.format(k)}")


_BARS_SQL = """SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS price,
  CAST(l_quantity AS BIGINT) AS size, l_returnflag AS flag, l_orderkey * 100 + l_linenumber AS line FROM lineitem
  WHERE CAST(l_shipdate AS DATE) IN (DATE '1998-01-05', DATE '1998-01-06', DATE '1998-01-07')"""


def all_lines(spark, sf) -> DataFrame:
    return i.table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("symbol"), i.day("l_shipdate").alias("date"),
        F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("bigint").alias("size"),
        F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line"),
    )


def _lines(spark, sf) -> DataFrame:
    days = [F.lit(f"1998-01-0{k}").cast("date") for k in (5, 6, 7)]
    return all_lines(spark, sf).filter(F.col("date").isin(*days))


@query(
    "bulk_files_round_trip",
    "S3 S4 P3 A5 Q11 K3 A9",
    f"""WITH lines AS ({_BARS_SQL}), whole AS (
      SELECT symbol, date, min(price) AS low, max(price) AS high, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n
      FROM lines GROUP BY symbol, date)
    SELECT symbol, date, low AS open, high, low, high AS close, volume FROM whole WHERE date < DATE '1998-01-07'
    UNION ALL SELECT symbol, date, low, NULL, NULL, high, volume FROM whole WHERE date = DATE '1998-01-07'""",
)
def bulk_files_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """One folder of bulk files with three headers and odd names, all dates merged into an empty store."""
    folder = work_path(spark, "bulk files")
    whole = _lines(spark, sf).groupBy("symbol", "date").agg(
        F.min("price").alias("low"), F.max("price").alias("high"), F.sum("size").alias("volume")
    )
    text = {"Symbol": "symbol", "Open 1 day": "low", "High 1 day": "high", "Low 1 day": "low", "Price": "high", "Volume 1 day": "volume"}
    kinds = [("1998-01-05", list(text), "all_stocks _OHLCV_{}_"), ("1998-01-06", list(text)[::-1], "a#b+50%_{}_"), ("1998-01-07", list(text), "c [x]_{}_")]
    for day, order, name in kinds:
        rows = whole.filter(F.col("date") == F.lit(day).cast("date")).select(*[F.col(text[h]).alias(h) for h in order])
        if name.startswith("c"):
            rows = rows.withColumn("High 1 day", F.lit("n/a")).withColumn("Low 1 day", F.lit(None).cast("string"))
        land_csv(rows.withColumn("note", F.lit('said "so", twice')), folder, f"{name}{day}.csv")
    land_csv(whole.select("symbol"), folder, "other columns {} 1998-01-06.csv")
    store = work_path(spark, "bars")
    run_backfill(spark, folder, None, store)
    return read_bars(spark, store, "1d").select("symbol", "date", "open", "high", "low", "close", "volume")


@query(
    "history_folder_round_trip",
    "S7 S1",
    """SELECT concat('^', n_name, ' +%') AS symbol, CAST(c_custkey AS BIGINT) AS pos_no, c_acctbal AS close
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def history_folder_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """One CSV file for each symbol, with names such as ``^PERU +%.csv``; volumes carry the row's number."""
    folder, parts = work_path(spark, "history"), work_path(spark, "landing")
    nations = i.table(spark, sf, "nation")
    rows = i.table(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.select("n_nationkey", F.lit("2024-01-02").alias("Date"), F.col("c_acctbal").alias("Close"), F.col("c_custkey").alias("Volume"))
    rows.repartition("n_nationkey").write.partitionBy("n_nationkey").option("header", True).csv(parts)
    for key, name in nations.select("n_nationkey", "n_name").collect():  # 25 files
        for part in glob(spark, f"{parts}/n_nationkey={key}/part-*"):
            rename(spark, part, f"{folder}/^{name} +%.csv")
    return read_history_folder(spark, folder).select("symbol", F.col("volume").alias("pos_no"), "close")


_FIRST_SQL = """first AS (SELECT symbol, date, price AS close, size AS volume FROM ({bars})
  QUALIFY row_number() OVER (PARTITION BY symbol, date ORDER BY line) = 1)"""


@query(
    "batch_job_round_trip",
    "Q1 K1 A8 S8",
    f"""WITH {_FIRST_SQL.format(bars=_BARS_SQL)}
    SELECT symbol, date, close, volume, FALSE AS rejected FROM first
    WHERE CAST(symbol AS BIGINT) % 3 <> 0
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), DATE '1998-02-01', NULL, NULL, TRUE FROM part
    WHERE p_partkey % 3 <> 0 AND CAST(p_partkey AS VARCHAR) NOT IN (SELECT symbol FROM first)""",
)
def batch_job_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the batch job, the second the same as the first: stored bars and the reject list."""
    bars, rejects = work_path(spark, "bars"), work_path(spark, "rejects")
    asked = i.table(spark, sf, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").cast("string").alias("symbol"), F.col("p_partkey").alias("pos"))
    landed = _lines(spark, sf).select("symbol", "date", *[F.col("price").alias(c) for c in ("open", "high", "low", "close", "adj_close")], F.col("size").alias("volume"), F.col("line").alias("pos"))
    for _ in range(2):
        run_batch(spark, {"1d": landed}, asked, bars, rejects, date(1998, 2, 1), use_rejects=False)
    stored = read_bars(spark, bars, "1d").select("symbol", "date", "close", "volume", F.lit(False).alias("rejected"))
    none = F.lit(None)
    gone = read_table(spark, rejects, BATCH_REJECTS).select(
        "symbol", F.col("first_seen").alias("date"), none.cast("double").alias("close"), none.cast("bigint").alias("volume"), F.lit(True).alias("rejected")
    )
    return stored.unionByName(gone)


@query(
    "history_job_round_trip",
    "Q2 K2 K8 K9",
    f"""WITH lines AS ({_BARS_SQL}), kept AS (
      SELECT symbol, CAST(date + INTERVAL 25 YEAR AS DATE) AS date, max(price) AS close FROM lines GROUP BY symbol, date)
    SELECT symbol, date, close, NULL AS reason FROM kept
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), DATE '2023-02-01', NULL, 'no data' FROM part
    WHERE CAST(p_partkey AS VARCHAR) NOT IN (SELECT symbol FROM kept)""",
)
def history_job_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the history job: the second delivers the last day and a list of rejects that replaces the first."""
    bars, rejects, clean = (work_path(spark, n) for n in ("bars", "rejects", "clean"))
    asked = i.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("symbol"))
    lines = _lines(spark, sf).withColumn("date", F.add_months("date", 300))  # daily histories start in 2020
    landed = lines.groupBy("symbol", "date").agg(F.max("price").alias("close")).withColumn("pos", F.lit(0))
    early = F.col("date") < F.lit("2023-01-07").cast("date")
    for rows in (landed.filter(early), landed.filter(~early)):
        run_history(spark, asked, rows, bars, "1d", rejects, clean, date(2023, 2, 1))
    stored = read_bars(spark, bars, "1d").select("symbol", "date", "close", F.lit(None).cast("string").alias("reason"))
    gone = read_table(spark, rejects, REJECTS).filter("source = 'history'")
    return stored.unionByName(gone.select("symbol", F.col("first_seen").alias("date"), F.lit(None).cast("double").alias("close"), "reason"))


@query(
    "ratio_job_round_trip",
    "Q7 K10 O8 S10",
    """WITH daily AS (
      SELECT CAST(ts AS DATE) AS date, count(*) FILTER (event_type = 'purchase') AS p, count(*) AS n FROM events GROUP BY 1),
    seen AS (SELECT date, p / 100.0 AS ratio FROM daily WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')
    SELECT date, CAST(ratio AS DOUBLE) AS ratio FROM seen ORDER BY date DESC LIMIT 10""",
)
def ratio_job_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with one ratio a day, every page landed twice; the job runs twice on an empty series."""
    daily = i.table(spark, sf, "events").groupBy(i.day("ts").alias("date")).agg(F.count_if(F.col("event_type") == "purchase").alias("p"))
    value = F.format_string(">EQUITY PUT/CALL RATIO</td><td>%d.%02d</td>", (F.col("p") / 100).cast("bigint"), F.col("p") % 100)
    pages = daily.select(F.concat(F.lit("http://x/?dt="), F.date_format("date", "yyyy-MM-dd")).alias("url"), value.alias("html"))
    path = work_path(spark, "series")
    for _ in range(2):
        run_ratio(spark, pages.union(pages), path, date(2024, 1, 30))
    return read_table(spark, path, RATIO_SERIES)


@query(
    "universe_job_round_trip",
    "Q4 Q5 K4 K5 K6 S2 M14",
    """WITH u AS (SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_partkey % 4 AS k FROM part)
    SELECT symbol, '0' AS choice, k = 1 AS sp500 FROM u
    UNION ALL SELECT symbol, '1', k = 1 FROM u WHERE k = 1
    UNION ALL SELECT symbol, '2', FALSE FROM u WHERE k = 2
    UNION ALL SELECT symbol, '1-2', k = 1 FROM u WHERE k IN (1, 2)""",
)
def universe_job_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """A universe file, read and flagged by the job, and the three tables of the choice ``1-2``."""
    folder, out = work_path(spark, "in"), work_path(spark, "out")
    index = F.element_at(F.array(F.lit("None"), F.lit("S&P 500"), F.lit("NASDAQ 100"), F.lit("Russell 2000")), (F.col("p_partkey") % 4 + 1).cast("int"))
    rows = i.table(spark, sf, "part").select(F.col("p_partkey").alias("Symbol"), F.col("p_name").alias("Description"), index.alias("Index"))
    land_csv(rows.coalesce(1), folder, "universe {}.csv")
    (path,) = [r["path"] for r in list_files(spark, folder).select("path").collect()]
    assert columns_of(spark, path) == ["Symbol", "Description", "Index"]
    run_choice(spark, "1-2", run_universe(spark, path, out), [], out)
    stored = spark.read.parquet(f"{out}/info")
    return stored.select("symbol", F.col("choice").cast("string").alias("choice"), F.col("SP500").alias("sp500"))


# The batch job over all days of lineitem and all parts.

_ALL_BARS_SQL = """SELECT CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS price,
  CAST(l_quantity AS BIGINT) AS size, l_orderkey * 100 + l_linenumber AS line FROM lineitem"""


@query(
    "batch_job_all_days_round_trip",
    "Q1 K1 A8 S8",
    f"""WITH {_FIRST_SQL.format(bars=_ALL_BARS_SQL)}
    SELECT symbol, date, close, volume, FALSE AS rejected FROM first
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), DATE '2002-01-01', NULL, NULL, TRUE FROM part
    WHERE CAST(p_partkey AS VARCHAR) NOT IN (SELECT symbol FROM first)""",
)
def batch_job_all_days_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of the batch job, the second the same as the first: stored bars and the reject list."""
    bars, rejects = work_path(spark, "bars"), work_path(spark, "rejects")
    asked = i.table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("symbol"), F.col("p_partkey").alias("pos"))
    landed = all_lines(spark, sf).select("symbol", "date", *[F.col("price").alias(c) for c in ("open", "high", "low", "close", "adj_close")], F.col("size").alias("volume"), F.col("line").alias("pos"))
    for _ in range(2):
        run_batch(spark, {"1d": landed}, asked, bars, rejects, date(2002, 1, 1), use_rejects=False)
    stored = read_bars(spark, bars, "1d").select("symbol", "date", "close", "volume", F.lit(False).alias("rejected"))
    none = F.lit(None)
    gone = read_table(spark, rejects, BATCH_REJECTS).select(
        "symbol", F.col("first_seen").alias("date"), none.cast("double").alias("close"), none.cast("bigint").alias("volume"), F.lit(True).alias("rejected")
    )
    return stored.unionByName(gone)


@query(
    "csv_line_breaks",
    "S2 S4",
    """SELECT CAST(p_partkey AS VARCHAR) AS symbol, p_name || chr(10) || 'said "' || p_brand || '", ' || chr(10) || chr(10) || p_type AS note,
      CASE WHEN p_size % 3 = 0 THEN ',' || chr(10) || '"' ELSE CAST(p_size AS VARCHAR) END AS size, CAST(p_retailprice AS DOUBLE) AS price FROM part""",
)
def csv_line_breaks(spark: SparkSession, sf: str) -> DataFrame:
    """All parts as CSV files whose quoted fields hold line breaks, blank lines, commas and quotes, read in small splits."""
    part = i.table(spark, sf, "part")
    note = F.concat("p_name", F.lit('\nsaid "'), "p_brand", F.lit('", \n\n'), "p_type")
    size = F.when(F.col("p_size") % 3 == 0, F.lit(',\n"')).otherwise(F.col("p_size").cast("string"))
    folder = work_path(spark, "line breaks")
    rows = part.select(F.col("p_partkey").alias("Symbol"), note.alias("a note,\nin two lines"), size.alias("Size"), F.col("p_retailprice").alias("Price"))
    rows.write.option("header", True).option("escape", '"').csv(folder)
    raw = read_csv(spark, [r["path"] for r in list_files(spark, folder).select("path").collect()])
    return raw.select(
        field("Symbol").alias("symbol"), field("a note,\nin two lines").alias("note"), field("Size").alias("size"),
        field("Price").try_cast("double").alias("price"),
    )
