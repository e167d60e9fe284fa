"""Queries over requested, delivered and rejected symbols."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.operators.coverage import newly_rejected, not_delivered, staleness, staleness_counts
from quoteloom.operators.info import clean_info, info, info_for, portfolio_clean_info
from quoteloom.operators.universe import exclude
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query


@query(
    "exclude_rejects",
    "J3",
    f"WITH {i.CUSTOMER_SQL} SELECT symbol FROM requested WHERE symbol NOT IN (SELECT symbol FROM known_rejects)",
)
def exclude_rejects(spark, sf):
    return exclude(i.requested(spark, sf), i.known_rejects(spark, sf))


@query(
    "newly_rejected",
    "J7 P22 B4",
    f"""WITH {i.CUSTOMER_SQL}
    SELECT symbol, DATE '2001-08-01' AS first_seen FROM requested WHERE symbol NOT IN (SELECT symbol FROM delivered)""",
)
def newly_rejected_query(spark, sf):
    bars = i.delivered(spark, sf).select("symbol", F.lit("1d").alias("interval"))
    return newly_rejected(i.requested(spark, sf), bars, "2001-08-01")


@query(
    "symbols_difference",
    "U9",
    f"WITH {i.CUSTOMER_SQL} SELECT symbol FROM requested EXCEPT SELECT symbol FROM delivered",
)
def symbols_difference(spark, sf):
    return not_delivered(i.requested(spark, sf), i.delivered(spark, sf))


_STALE_SQL = f"""{i.CUSTOMER_SQL}, report AS (
  SELECT r.symbol, max(date) AS last_date,
         CASE WHEN max(date) IS NULL OR DATE '2001-07-01' > max(date) THEN 'behind' ELSE 'current' END AS status
  FROM requested r LEFT JOIN stored s ON r.symbol = s.symbol GROUP BY r.symbol)"""


@query("staleness_report", "J8 A3", f"WITH {_STALE_SQL} SELECT * FROM report")
def staleness_report(spark, sf):
    return staleness(i.requested(spark, sf), i.stored_orders(spark, sf), "2001-07-01")


@query(
    "staleness_counts",
    "A4",
    f"""WITH {_STALE_SQL} SELECT count(*) FILTER (status = 'behind') AS behind,
      count(*) FILTER (status = 'current') AS current FROM report""",
)
def staleness_counts_query(spark, sf):
    return staleness_counts(staleness(i.requested(spark, sf), i.stored_orders(spark, sf), "2001-07-01"))


_INFO_COLUMNS = """symbol, description, market_capitalization, market_cap_currency, sector, industry, exchange,
  CAST(NULL AS VARCHAR) AS analyst_rating, CAST(NULL AS VARCHAR) AS upcoming_earnings_date,
  CAST(NULL AS VARCHAR) AS recent_earnings_date"""


@query(
    "clean_info",
    "J1 Q8 K9",
    f"WITH {i.CUSTOMER_SQL} SELECT {_INFO_COLUMNS} FROM info WHERE symbol IN (SELECT symbol FROM delivered)",
)
def clean_info_query(spark, sf):
    return clean_info(info(i.company_universe(spark, sf)), i.delivered(spark, sf))


@query(
    "portfolio_clean_info",
    "J4 Q8 M14",
    f"""WITH {i.CUSTOMER_SQL} SELECT {_INFO_COLUMNS} FROM info
    WHERE symbol IN (SELECT symbol FROM delivered) AND symbol IN (SELECT symbol FROM portfolio)""",
)
def portfolio_clean_info_query(spark, sf):
    return portfolio_clean_info(
        info(i.company_universe(spark, sf)), i.delivered(spark, sf), i.portfolio(spark, sf)
    )


@query(
    "info_for_symbols",
    "J2 P13 Q8",
    f"WITH {i.CUSTOMER_SQL} SELECT {_INFO_COLUMNS} FROM info WHERE symbol IN (SELECT symbol FROM portfolio)",
)
def info_for_symbols(spark, sf):
    return info_for(i.company_universe(spark, sf), i.portfolio(spark, sf))
