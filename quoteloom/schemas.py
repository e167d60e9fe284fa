"""Schemas of the tables this library reads and writes."""

from pyspark.sql import DataFrame, SparkSession


def ddl(text: str) -> str:
    return " ".join(text.split())


# One row per interval, symbol and calendar date.
BARS = ddl(
    """interval string, date date, symbol string, open double, high double, low double,
    close double, adj_close double, volume bigint, source string"""
)
REJECTS = "symbol string, source string, interval string, reason string, first_seen date"
RATIO_SERIES = "date date, ratio double"
STATEMENTS = ddl(
    """symbol string, freq string, item string, item_pos bigint, period_end date, value double"""
)
PAGES = "url string, html string"

# Headers a bulk snapshot must have, and the bar columns they become.
BULK_COLUMNS = [
    ("Symbol", "symbol"),
    ("Open 1 day", "open"),
    ("High 1 day", "high"),
    ("Low 1 day", "low"),
    ("Price", "close"),
    ("Volume 1 day", "volume"),
]

# The snapshot attributes attached to history bars.
SNAPSHOT_ATTRIBUTES = [
    ("volume", "bigint"),
    ("averageDailyVolume10Day", "bigint"),
    ("fiftyTwoWeekHigh", "double"),
    ("fiftyTwoWeekLow", "double"),
    ("fiftyDayAverage", "double"),
    ("twoHundredDayAverage", "double"),
    ("marketCap", "double"),
    ("industry", "string"),
    ("sector", "string"),
    ("exchange", "string"),
    ("trailingPE", "double"),
    ("forwardPE", "double"),
]

# The company attributes of the fundamentals table, with the text ones first.
TEXT_ATTRIBUTES = [
    "sector", "industry", "shortName", "longName", "exchange", "country", "currency", "recommendationKey",
]
NUMBER_ATTRIBUTES = [
    "marketCap", "enterpriseValue",
    "currentRatio", "quickRatio", "trailingEps", "forwardEps", "trailingPE", "forwardPE", "pegRatio",
    "earningsGrowth", "revenueGrowth", "earningsQuarterlyGrowth", "revenueQuarterlyGrowth",
    "returnOnEquity", "returnOnAssets", "grossMargins", "operatingMargins", "profitMargins", "ebitdaMargins",
    "sharesOutstanding", "floatShares", "sharesShort", "shortRatio", "shortPercentOfFloat",
    "heldPercentInsiders", "heldPercentInstitutions",
    "beta", "averageVolume", "averageVolume10days", "fiftyTwoWeekHigh", "fiftyTwoWeekLow",
    "fiftyDayAverage", "twoHundredDayAverage",
    "bookValue", "priceToBook", "numberOfAnalystOpinions", "targetHighPrice", "targetLowPrice",
    "targetMeanPrice",
    "debtToEquity", "totalDebt", "totalCash", "freeCashflow", "operatingCashflow", "revenuePerShare",
    "totalRevenue", "enterpriseToRevenue", "enterpriseToEbitda", "mostRecentQuarter", "netIncomeToCommon",
]

# The columns of the fundamentals summary, in order.
SUMMARY_COLUMNS = [
    "symbol", "sector", "industry", "marketCap", "earningsGrowth", "revenueGrowth",
    "earningsQuarterlyGrowth", "revenueQuarterlyGrowth", "trailingPE", "pegRatio", "returnOnEquity",
    "profitMargins", "shortPercentOfFloat", "heldPercentInstitutions",
]


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)
