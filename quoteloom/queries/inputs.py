"""Market-data inputs made from the given tables, in Spark and as SQL common table expressions.

Every input uses its whole table. Each pair below states the same rows twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.functions.text import cents, order_key
from quoteloom.operators.bars import bars_from_ticks, bars_of_label
from quoteloom.operators.universe import build_universe


# Given schemas, so that opening a table runs no job to look at its files.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def day(column: str) -> Column:
    return F.col(column).cast("date")


# --- ticks and daily bars from events ---------------------------------------------------------------

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

TICKS_SQL = """ticks AS (
  SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, ts, event_id AS seq, event_type,
         value AS price, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) AS size
  FROM events)"""

DAILY_SQL = TICKS_SQL + """, daily AS (
  SELECT symbol, date, arg_min(price, row(ts, seq)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, seq)) AS close, CAST(sum(size) AS BIGINT) AS volume
  FROM ticks GROUP BY symbol, date)"""


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("symbol"),
        day("ts").alias("date"),
        "ts",
        F.col("event_id").alias("seq"),
        "event_type",
        F.col("value").alias("price"),
        F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("bigint").alias("size"),
    )


def tick_order() -> Column:
    return order_key(F.unix_micros(F.col("ts").cast("timestamp")), F.col("seq"))


def tick_bars(rows: DataFrame, keys: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    return bars_from_ticks(rows, list(keys), "price", "size", tick_order())


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tick_bars(ticks(spark, sf_dir))


# --- daily bars from lineitem: by part (many symbols), by supplier (long histories) -------------------

def _line_sql(name: str, key: str) -> str:
    return f"""{name} AS (
  SELECT CAST({key} AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date,
         arg_min(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber, l_partkey)) AS open,
         max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
         arg_max(l_extendedprice / l_quantity, row(l_orderkey, l_linenumber, l_partkey)) AS close,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
  FROM lineitem GROUP BY {key}, CAST(l_shipdate AS DATE))"""


PART_BARS_SQL = _line_sql("part_bars", "l_partkey")
SUPPLIER_BARS_SQL = _line_sql("supplier_bars", "l_suppkey")


def line_ticks(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col(key).alias("key"),
        day("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"),
        order_key(F.col("l_orderkey"), F.col("l_linenumber") * F.lit(1_000_000_000_000) + F.col("l_partkey")).alias("line"),
    )


def line_bars(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Grouped by the numeric key; the text symbol is only made for the finished bars."""
    bars = bars_from_ticks(line_ticks(spark, sf_dir, key), ["key", "date"], "price", "size", F.col("line"))
    return bars.select(F.col("key").cast("string").alias("symbol"), "date", "open", "high", "low", "close", "volume")


def part_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_bars(spark, sf_dir, "l_partkey")


def part_bars_by(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Weekly or monthly bars by part; lines are ranked by order, line number and part as in the daily bars."""
    bars = bars_of_label(line_ticks(spark, sf_dir, "l_partkey"), ["key"], unit, "price", "size", F.col("line"))
    return bars.select(F.col("key").cast("string").alias("symbol"), "date", "open", "high", "low", "close", "volume")


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_bars(spark, sf_dir, "l_suppkey")


# --- universe from part ---------------------------------------------------------------------------

RAW_UNIVERSE_SQL = r"""raw_universe AS (
  SELECT p_partkey AS pos,
         CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN 'NaN' ELSE concat(
           CASE WHEN p_type = 'MEDIUM' THEN ' ' ELSE '' END, upper(substr(p_name, 1, 2)),
           CAST(p_partkey // 4 AS VARCHAR),
           CASE p_brand WHEN 'Brand#3' THEN '.A' WHEN 'Brand#7' THEN '/PR' WHEN 'Brand#9' THEN '\W'
             WHEN 'Brand#11' THEN ' ' ELSE '' END) END AS raw_symbol,
         p_name AS description, p_retailprice * p_size AS market_cap, p_type AS sector,
         p_brand AS industry, CASE WHEN p_size < 20 THEN 'NASDAQ' ELSE 'NYSE' END AS exchange,
         CASE p_type WHEN 'LARGE' THEN 'S&P 500, Russell 1000, Russell 3000, '
           WHEN 'MEDIUM' THEN 'S&P MidCap 400, Russell 1000, '
           WHEN 'SMALL' THEN 'Russell 2000, Russell 3000,, '
           WHEN 'PROMO' THEN 'NASDAQ 100, NASDAQ Composite, S&P 500, '
           WHEN 'ECONOMY' THEN 'NASDAQ Composite, NASDAQ Bank, ' END || p_brand AS index_text
  FROM part)"""

UNIVERSE_SQL = RAW_UNIVERSE_SQL + """, cleaned AS (
  SELECT *, CASE WHEN strpos(trim(raw_symbol), '/') = 0
                 THEN replace(nullif(trim(raw_symbol), ''), '.', '-') END AS symbol
  FROM raw_universe), universe AS (
  SELECT * FROM cleaned WHERE symbol IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY pos) = 1)"""

MEMBERSHIP_SQL = UNIVERSE_SQL + """, membership AS (
  SELECT DISTINCT symbol, translate(trim(name), ' &-./()', '') AS index_key
  FROM (SELECT symbol, unnest(string_split(index_text, ',')) AS name FROM universe)
  WHERE trim(name) <> '')"""

_RAW_SYMBOL = r"""CASE WHEN p_size = 50 THEN NULL WHEN p_size = 49 THEN 'NaN' ELSE concat(
  CASE WHEN p_type = 'MEDIUM' THEN ' ' ELSE '' END, upper(substr(p_name, 1, 2)),
  CAST(p_partkey div 4 AS STRING),
  CASE p_brand WHEN 'Brand#3' THEN '.A' WHEN 'Brand#7' THEN '/PR' WHEN 'Brand#9' THEN '\\W'
    WHEN 'Brand#11' THEN ' ' ELSE '' END) END"""

_INDEX_TEXT = """CASE p_type WHEN 'LARGE' THEN 'S&P 500, Russell 1000, Russell 3000, '
  WHEN 'MEDIUM' THEN 'S&P MidCap 400, Russell 1000, '
  WHEN 'SMALL' THEN 'Russell 2000, Russell 3000,, '
  WHEN 'PROMO' THEN 'NASDAQ 100, NASDAQ Composite, S&P 500, '
  WHEN 'ECONOMY' THEN 'NASDAQ Composite, NASDAQ Bank, ' END || p_brand"""


def raw_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.expr(_RAW_SYMBOL).alias("symbol"), F.col("p_partkey").alias("pos")
    )


def raw_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Under the headers of a landed universe file."""
    return table(spark, sf_dir, "part").select(
        F.expr(_RAW_SYMBOL).alias(" Symbol "),
        F.col("p_name").alias("Description"),
        (F.col("p_retailprice") * F.col("p_size")).alias("Market capitalization"),
        F.lit("USD").alias("Market capitalization - Currency"),
        F.col("p_type").alias("Sector"),
        F.col("p_brand").alias("Industry"),
        F.when(F.col("p_size") < 20, "NASDAQ").otherwise("NYSE").alias("Exchange"),
        F.expr(_INDEX_TEXT).alias("Index"),
        F.col("p_partkey").alias("pos"),
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_universe(raw_universe(spark, sf_dir))


# --- symbols, deliveries, rejects and portfolio from customer and orders -------------------------------

DELIVERY_START = "2001-01-01"

CUSTOMER_SQL = f"""requested AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer),
known_rejects AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol, CAST(DATE '2000-01-01' + c_nationkey AS DATE) AS first_seen
  FROM customer WHERE c_acctbal < 0),
stored AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderdate AS DATE) AS date FROM orders),
delivered AS (SELECT DISTINCT symbol FROM stored WHERE date >= DATE '{DELIVERY_START}'),
portfolio AS (SELECT CAST(c_custkey AS VARCHAR) AS symbol FROM customer WHERE c_mktsegment = 'BUILDING'),
info AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS description, c_acctbal AS market_capitalization,
         'USD' AS market_cap_currency, c_mktsegment AS sector, n_name AS industry, r_name AS exchange
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("symbol"))


def known_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").cast("string").alias("symbol"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("c_nationkey")).alias("first_seen"),
    )


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("symbol"), day("o_orderdate").alias("date")
    )


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_orders(spark, sf_dir).filter(F.col("date") >= F.lit(DELIVERY_START).cast("date"))


def portfolio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").cast("string").alias("symbol")
    )


def company_universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_custkey").cast("string").alias("symbol"),
            F.col("c_name").alias("description"),
            F.col("c_acctbal").alias("market_cap"),
            F.lit("USD").alias("market_cap_currency"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("industry"),
            F.col("r_name").alias("exchange"),
        )
    )


# --- statements and company attributes from orders ---------------------------------------------------

STATEMENTS_SQL = """lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS item_pos,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Total Revenue' WHEN '2' THEN 'Cost Of Revenue'
           WHEN '3' THEN 'Operating Income' WHEN '4' THEN 'Net Income Common Stockholders'
           ELSE 'Net Income' END AS item,
         CAST(floor(o_totalprice * 100.0 + 0.5) AS BIGINT) AS amount,
         CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
         CAST(date_trunc('year', o_orderdate) + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS year_end
  FROM orders), statements AS (
  SELECT symbol, 'q' AS freq, item, item_pos, quarter_end AS period_end,
         CAST(sum(amount) AS DOUBLE) / 100.0 AS value FROM lines GROUP BY ALL
  UNION ALL
  SELECT symbol, 'y' AS freq, item, item_pos, year_end AS period_end,
         CAST(sum(amount) AS DOUBLE) / 100.0 AS value FROM lines GROUP BY ALL)"""


def _line_item() -> Column:
    p = F.substring("o_orderpriority", 1, 1)
    return (
        F.when(p == "1", "Total Revenue")
        .when(p == "2", "Cost Of Revenue")
        .when(p == "3", "Operating Income")
        .when(p == "4", "Net Income Common Stockholders")
        .otherwise("Net Income")
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as statement lines: priority is the line item, totals per quarter and per year.

    Each order is counted for its quarter and its year in one aggregate.
    """
    d = day("o_orderdate")
    periods = F.array(
        F.struct(F.lit("q").alias("freq"), F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1).alias("period_end")),
        F.struct(F.lit("y").alias("freq"), F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1).alias("period_end")),
    )
    lines = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("item_pos"),
        _line_item().alias("item"),
        cents(F.col("o_totalprice")).alias("amount"),
        F.inline(periods),
    )
    total = (F.sum("amount").cast("double") / F.lit(100.0)).alias("value")
    return (
        lines.groupBy("o_custkey", "freq", "item", "item_pos", "period_end").agg(total)
        .select(F.col("o_custkey").cast("string").alias("symbol"), "freq", "item", "item_pos", "period_end", "value")
    )


COMPANY_SQL = """totals AS (
  SELECT o_custkey, CAST(sum(amount) AS DOUBLE) AS all_amount, CAST(count(*) AS DOUBLE) AS n,
         CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS n_f,
         CAST(count(*) FILTER (o_orderstatus = 'O') AS DOUBLE) AS n_o,
         count(*) FILTER (o_orderpriority = '1-URGENT') AS n_urgent,
         CAST(sum(amount) FILTER (d >= DATE '2001-01-01') AS DOUBLE) AS half_now,
         CAST(sum(amount) FILTER (d >= DATE '2000-01-01' AND d < DATE '2000-07-01') AS DOUBLE) AS half_before,
         CAST(sum(amount) FILTER (d >= DATE '2000-01-01' AND d < DATE '2001-01-01') AS DOUBLE) AS year_now,
         CAST(sum(amount) FILTER (d >= DATE '1999-01-01' AND d < DATE '2000-01-01') AS DOUBLE) AS year_before
  FROM (SELECT *, CAST(floor(o_totalprice * 100.0 + 0.5) AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS d FROM orders)
  GROUP BY o_custkey), companies AS (
  SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_mktsegment AS sector, n_name AS industry,
         all_amount * 10.0 AS marketcap,
         (half_now - half_before) / half_before AS earningsquarterlygrowth,
         (year_now - year_before) / year_before AS earningsgrowth,
         c_acctbal / 50000.0 AS returnonequity, n_f / n / 2.0 AS shortpercentoffloat,
         n_o / n AS heldpercentinstitutions, CAST(n_urgent AS DOUBLE) AS numberofanalystopinions
  FROM customer LEFT JOIN totals ON c_custkey = o_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes per customer: growth of its orders, shares of their states, its balance."""
    d = F.col("d")
    amount = F.col("amount")

    def between(first: str, end: str) -> Column:
        inside = (d >= F.lit(first).cast("date")) & (d < F.lit(end).cast("date"))
        return F.sum(F.when(inside, amount)).cast("double")

    n = F.count("*").cast("double")
    totals = (
        table(spark, sf_dir, "orders")
        .select("o_custkey", "o_orderstatus", "o_orderpriority", day("o_orderdate").alias("d"), cents(F.col("o_totalprice")).alias("amount"))
        .groupBy("o_custkey")
        .agg(
            F.sum("amount").cast("double").alias("all_amount"),
            (F.count_if(F.col("o_orderstatus") == "F").cast("double") / n).alias("share_f"),
            (F.count_if(F.col("o_orderstatus") == "O").cast("double") / n).alias("share_o"),
            F.count_if(F.col("o_orderpriority") == "1-URGENT").cast("double").alias("urgent"),
            F.sum(F.when(d >= F.lit("2001-01-01").cast("date"), amount)).cast("double").alias("half_now"),
            between("2000-01-01", "2000-07-01").alias("half_before"),
            between("2000-01-01", "2001-01-01").alias("year_now"),
            between("1999-01-01", "2000-01-01").alias("year_before"),
        )
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "customer")
        .join(totals, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").cast("string").alias("symbol"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("industry"),
            (F.col("all_amount") * 10.0).alias("marketCap"),
            F.try_divide(F.col("half_now") - F.col("half_before"), F.col("half_before")).alias("earningsQuarterlyGrowth"),
            F.try_divide(F.col("year_now") - F.col("year_before"), F.col("year_before")).alias("earningsGrowth"),
            (F.col("c_acctbal") / 50000.0).alias("returnOnEquity"),
            (F.col("share_f") / 2.0).alias("shortPercentOfFloat"),
            F.col("share_o").alias("heldPercentInstitutions"),
            F.col("urgent").alias("numberOfAnalystOpinions"),
        )
    )
