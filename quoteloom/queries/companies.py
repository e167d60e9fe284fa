"""Queries over company statements and attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.operators.fundamentals import (
    first_matching_items,
    fundamentals_summary,
    fundamentals_wide,
    growth,
    margins,
    statements_from_wide,
    with_fundamentals,
)
from quoteloom.operators.info import attributes_from_json, info_from_attributes
from quoteloom.operators.screen import funnel, growth_acceleration, score, screen, top
from quoteloom.queries import inputs as i
from quoteloom.queries.registry import query

_MATCH = {
    "net_income": "contains(lower(item), 'net income')",
    "revenue": "contains(lower(item), 'revenue')",
    "operating_income": "contains(lower(item), 'operating income')",
}

_SLOTS_SQL = i.STATEMENTS_SQL + """, firsts AS (
  SELECT symbol, freq, """ + ", ".join(
    f"min(item_pos) FILTER ({m}) AS {k}_pos, arg_min(item, item_pos) FILTER ({m}) AS {k}_item" for k, m in _MATCH.items()
) + """ FROM statements GROUP BY symbol, freq), slots AS (
  SELECT s.symbol, s.freq, s.period_end,
         row_number() OVER (PARTITION BY s.symbol, s.freq ORDER BY s.period_end DESC) AS slot, """ + ", ".join(
    f"max(s.value) FILTER (s.item_pos = {k}_pos) AS {k}" for k in _MATCH
) + """, bool_or(net_income_pos IS NOT NULL) AS has_net_income
  FROM statements s JOIN firsts USING (symbol, freq) GROUP BY s.symbol, s.freq, s.period_end)"""


def _at(freq: str, n: int, value: str) -> str:
    return f"max({value}) FILTER (freq = '{freq}' AND slot = {n})"


_WIDE_COLUMNS = [
    (name, _at("q", n, value))
    for n in range(1, 13)
    for name, value in (
        (f"q{n}_net_income", "net_income"),
        (f"q{n}_date", "CASE WHEN has_net_income THEN period_end END"),
        (f"q{n}_revenue", "revenue"),
        (f"q{n}_operating_income", "operating_income"),
    )
] + [
    (name, value)
    for n in range(1, 6)
    for name, value in (
        (f"y{n}_net_income", _at("y", n, "net_income")),
        (f"y{n}_year", "CAST(" + _at("y", n, "CASE WHEN has_net_income THEN year(period_end) END") + " AS INTEGER)"),
        (f"y{n}_revenue", _at("y", n, "revenue")),
    )
]

_WIDE_SQL = _SLOTS_SQL + ", wide AS (SELECT symbol, " + ", ".join(
    f"{sql} AS {name}" for name, sql in _WIDE_COLUMNS
) + " FROM slots GROUP BY symbol)"


@query("statements_long", "M7 S13", f"WITH {i.STATEMENTS_SQL} SELECT * FROM statements")
def statements_long(spark, sf):
    return i.statements(spark, sf)


@query(
    "statements_from_matrix",
    "S13",
    """SELECT CAST(o_custkey AS VARCHAR) AS symbol, 'y' AS freq, o_orderpriority AS item,
      CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS item_pos, make_date(y, 12, 31) AS period_end,
      CAST(sum(CAST(floor(o_totalprice * 100.0 + 0.5) AS BIGINT)) FILTER (year(o_orderdate) = y) AS DOUBLE) AS value
    FROM orders, (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS y) GROUP BY o_custkey, o_orderpriority, y""",
)
def statements_from_matrix(spark, sf):
    """A wide matrix, one column per year end, back to long rows."""
    amount = i.cents(F.col("o_totalprice"))
    year = F.year(i.day("o_orderdate"))
    wide = (
        i.table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").cast("string").alias("symbol"), F.col("o_orderpriority").alias("item"))
        .agg(*[F.sum(F.when(year == y, amount)).cast("double").alias(f"{y}-12-31") for y in range(1995, 2002)])
        .withColumn("item_pos", F.substring("item", 1, 1).cast("bigint"))
    )
    return statements_from_wide(wide, "y")


@query(
    "first_matching_item",
    "W5",
    f"WITH {_SLOTS_SQL} SELECT symbol, freq, net_income_item, revenue_item, operating_income_item FROM firsts",
)
def first_matching_item(spark, sf):
    return first_matching_items(i.statements(spark, sf))


@query("fundamentals_wide", "W4 W5 M8 Q6", f"WITH {_WIDE_SQL} SELECT * FROM wide")
def fundamentals_wide_query(spark, sf):
    return fundamentals_wide(i.statements(spark, sf))


_COMPANY_COLUMNS = """symbol, sector, industry, marketcap AS "marketCap",
  earningsquarterlygrowth AS "earningsQuarterlyGrowth", earningsgrowth AS "earningsGrowth",
  returnonequity AS "returnOnEquity", shortpercentoffloat AS "shortPercentOfFloat",
  heldpercentinstitutions AS "heldPercentInstitutions", numberofanalystopinions AS "numberOfAnalystOpinions\""""


@query(
    "fundamentals_table",
    "Q6 U6 M6 M8",
    f"""WITH {_WIDE_SQL}, {i.COMPANY_SQL}
    SELECT {_COMPANY_COLUMNS}, {", ".join(n for n, _ in _WIDE_COLUMNS)}
    FROM companies LEFT JOIN wide USING (symbol)""",
)
def fundamentals_table_query(spark, sf):
    return with_fundamentals(i.companies(spark, sf), fundamentals_wide(i.statements(spark, sf)))


@query(
    "fundamentals_summary",
    "P16 P17 O4 K7",
    f"""WITH {i.COMPANY_SQL}
    SELECT symbol, sector, industry, marketcap AS "marketCap", earningsgrowth AS "earningsGrowth",
           earningsquarterlygrowth AS "earningsQuarterlyGrowth", returnonequity AS "returnOnEquity",
           shortpercentoffloat AS "shortPercentOfFloat", heldpercentinstitutions AS "heldPercentInstitutions"
    FROM companies ORDER BY marketcap DESC NULLS LAST, symbol""",
)
def fundamentals_summary_query(spark, sf):
    return fundamentals_summary(i.companies(spark, sf))


def _growth_sql(freq: str, steps: int, number: str) -> str:
    return f"""WITH {i.STATEMENTS_SQL}, totals AS (
      SELECT symbol, period_end, CAST(sum(CAST(floor(value * 100.0 + 0.5) AS BIGINT)) AS DOUBLE) AS value,
             {number} AS n FROM statements WHERE freq = '{freq}' GROUP BY symbol, period_end)
    SELECT a.symbol, a.period_end, a.value,
           CASE WHEN b.value <> 0 THEN (a.value - b.value) / b.value END AS growth
    FROM totals a LEFT JOIN totals b ON a.symbol = b.symbol AND a.n = b.n + {steps}"""


def _totals(spark, sf, freq: str):
    rows = i.statements(spark, sf).filter(F.col("freq") == freq)
    return rows.groupBy("symbol", "period_end").agg(F.sum(i.cents(F.col("value"))).cast("double").alias("value"))


@query("growth_yoy", "R7", _growth_sql("q", 4, "year(period_end) * 4 + quarter(period_end)"))
def growth_yoy(spark, sf):
    return growth(_totals(spark, sf, "q"), 4, "quarter")


@query("growth_annual", "R7", _growth_sql("y", 1, "year(period_end)"))
def growth_annual(spark, sf):
    return growth(_totals(spark, sf, "y"), 1, "year")


@query(
    "margins",
    "R8",
    f"""WITH {_SLOTS_SQL} SELECT symbol, freq, period_end,
      CASE WHEN revenue <> 0 THEN net_income / revenue END AS profit_margin,
      CASE WHEN revenue <> 0 THEN operating_income / revenue END AS operating_margin FROM slots""",
)
def margins_query(spark, sf):
    return margins(i.statements(spark, sf))


@query(
    "attribute_snapshot",
    "S12 P17 P19 N3 F10",
    """SELECT CAST(event_id AS VARCHAR) AS symbol, event_type AS sector,
      CASE WHEN event_type = 'error' THEN NULL ELSE value END AS "marketCap",
      CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS DOUBLE) AS "trailingPE",
      CASE WHEN event_type = 'click' THEN 'EUR' END AS currency FROM events""",
)
def attribute_snapshot(spark, sf):
    """Events as landed JSON documents, with ``N/A`` for some numbers, parsed back."""
    kind = F.col("event_type")
    cap = F.when(kind == "error", "N/A").otherwise(F.col("value").cast("string"))
    json = F.to_json(
        F.struct(
            kind.alias("sector"), cap.alias("marketCap"),
            F.regexp_extract("props", '"k": ([0-9]+)', 1).alias("trailingPE"),
            F.when(kind == "click", "EUR").alias("currency"),
        )
    )
    landed = i.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("symbol"), json.alias("json"))
    return attributes_from_json(landed).select("symbol", "sector", "marketCap", "trailingPE", "currency")


@query(
    "attribute_info",
    "S12 P19",
    """SELECT CAST(event_id AS VARCHAR) AS symbol, CAST(NULL AS VARCHAR) AS description,
      CASE WHEN event_type = 'error' THEN NULL ELSE value END AS market_capitalization,
      CASE WHEN event_type = 'click' THEN 'EUR' ELSE 'USD' END AS market_cap_currency,
      event_type AS sector, CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS exchange,
      CAST(NULL AS VARCHAR) AS analyst_rating, CAST(NULL AS VARCHAR) AS upcoming_earnings_date,
      CAST(NULL AS VARCHAR) AS recent_earnings_date FROM events""",
)
def attribute_info(spark, sf):
    kind = F.col("event_type")
    cap = F.when(kind == "error", "N/A").otherwise(F.col("value").cast("string"))
    json = F.to_json(
        F.struct(kind.alias("sector"), cap.alias("marketCap"), F.when(kind == "click", "EUR").alias("currency"))
    )
    landed = i.table(spark, sf, "events").select(F.col("event_id").cast("string").alias("symbol"), json.alias("json"))
    return info_from_attributes(attributes_from_json(landed))


def _acceleration_sql(kind: str) -> str:
    listed = ", ".join(f"q{n}_{kind}" for n in range(1, 9))
    a = f"[x FOR x IN [{listed}] IF x IS NOT NULL]"
    recent, prior = f"(({a}[1] + {a}[2]) / 2)", f"(({a}[3] + {a}[4]) / 2)"
    return f"CASE WHEN len({a}) >= 4 AND {prior} <> 0 THEN ({recent} - {prior}) / abs({prior}) * 100 END"


@query(
    "growth_acceleration",
    "A10 F14",
    f"""WITH {_WIDE_SQL} SELECT symbol, {_acceleration_sql('net_income')} AS earnings_acceleration,
      {_acceleration_sql('revenue')} AS revenue_acceleration FROM wide""",
)
def growth_acceleration_query(spark, sf):
    wide = fundamentals_wide(i.statements(spark, sf))
    return growth_acceleration(wide).select("symbol", "earnings_acceleration", "revenue_acceleration")


_SCORE_SQL = i.COMPANY_SQL + """, points AS (SELECT *,
  CASE WHEN earningsquarterlygrowth > 0.25 THEN 25 WHEN earningsquarterlygrowth > 0.10 THEN 15
       WHEN earningsquarterlygrowth > 0 THEN 5 ELSE 0 END AS c_points,
  CASE WHEN earningsgrowth > 0.20 THEN 15 WHEN earningsgrowth > 0.10 THEN 10 WHEN earningsgrowth > 0 THEN 3 ELSE 0 END
    + CASE WHEN returnonequity > 0.15 THEN 5 ELSE 0 END AS a_points,
  7 AS n_points,
  CASE WHEN shortpercentoffloat < 0.10 THEN 8 WHEN shortpercentoffloat < 0.20 THEN 5 ELSE 0 END
    + CASE WHEN heldpercentinstitutions BETWEEN 0.40 AND 0.80 THEN 7 WHEN heldpercentinstitutions > 0.20 THEN 3 ELSE 0 END AS s_points,
  CASE WHEN marketcap > 2000000000 THEN 10 WHEN marketcap > 300000000 THEN 5 ELSE 0 END AS l_points,
  CASE WHEN numberofanalystopinions >= 3 THEN 10 WHEN numberofanalystopinions >= 1 THEN 5 ELSE 0 END AS i_points
  FROM companies), scored AS (
  SELECT *, c_points + a_points + n_points + s_points + l_points + i_points AS canslim_score FROM points)"""

_POINTS = ["c_points", "a_points", "n_points", "s_points", "l_points", "i_points"]
_PASS = "earningsquarterlygrowth > 0.20 AND earningsgrowth > 0.15 AND shortpercentoffloat < 0.20 AND marketcap > 300000000"


@query(
    "canslim_score",
    "A11 Q10",
    f"""WITH {_SCORE_SQL} SELECT symbol, {", ".join(_POINTS)}, canslim_score,
      CAST(canslim_score AS DOUBLE) AS canslim_score_percentage FROM scored""",
)
def canslim_score(spark, sf):
    return score(i.companies(spark, sf)).select("symbol", *_POINTS, "canslim_score", "canslim_score_percentage")


@query("canslim_screen", "P20 Q10", f"WITH {_SCORE_SQL} SELECT symbol, canslim_score FROM scored WHERE {_PASS}")
def canslim_screen(spark, sf):
    return screen(score(i.companies(spark, sf))).select("symbol", "canslim_score")


@query(
    "canslim_top5",
    "O6",
    f"WITH {_SCORE_SQL} SELECT symbol, canslim_score FROM scored ORDER BY canslim_score DESC, symbol LIMIT 5",
)
def canslim_top5(spark, sf):
    return top(score(i.companies(spark, sf))).select("symbol", "canslim_score")


def _funnel_sql() -> str:
    steps = [
        ("earningsQuarterlyGrowth", "earningsquarterlygrowth > 0.20"),
        ("earningsGrowth", "earningsgrowth > 0.15"),
        ("shortPercentOfFloat", "shortpercentoffloat < 0.20"),
        ("marketCap", "marketcap > 300000000"),
    ]
    rows = []
    for n, (name, test) in enumerate(steps, 1):
        so_far = " AND ".join(t for _, t in steps[:n])
        rows.append(
            f"SELECT {n} AS step, '{name}' AS criterion, count(*) FILTER ({test}) AS met, "
            f"count({name.lower()}) AS known, count(*) FILTER ({so_far}) AS remaining FROM companies"
        )
    return f"WITH {i.COMPANY_SQL} " + " UNION ALL ".join(rows)


@query("screen_funnel", "A12", _funnel_sql())
def screen_funnel(spark, sf):
    return funnel(i.companies(spark, sf))
