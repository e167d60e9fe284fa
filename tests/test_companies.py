from datetime import date

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.operators import fundamentals as f
from quoteloom.operators import screen as s


def statements(spark, data):
    df = spark.createDataFrame(data, "symbol string, freq string, item string, item_pos bigint, period_end string, value double")
    return df.withColumn("period_end", F.col("period_end").cast("date"))


def sample(spark):
    return statements(spark, [
        ("A", "q", "Cost Of Revenue", 1, "2024-03-31", 4.0),
        ("A", "q", "Total Revenue", 2, "2024-03-31", 10.0),
        ("A", "q", "Net Income Common", 3, "2024-03-31", 1.0),
        ("A", "q", "Net Income", 4, "2024-03-31", 99.0),
        ("A", "q", "OPERATING INCOME", 5, "2024-03-31", 2.0),
        ("A", "q", "Cost Of Revenue", 1, "2023-12-31", 3.0),
        ("A", "q", "Net Income", 4, "2023-12-31", 98.0),
        ("A", "q", "Net Income Common", 3, "2023-09-30", float("nan")),
        ("A", "q", "Net Income Common", 3, "2023-06-30", 0.5),
        ("A", "y", "Total Revenue", 2, "2023-12-31", 40.0),
        ("B", "q", "Total Revenue", 2, "2024-03-31", 7.0),
    ])


def test_first_matching_item_may_be_a_partial_name(spark):
    got = {(r["symbol"], r["freq"]): r for r in f.first_matching_items(sample(spark)).collect()}
    assert got["A", "q"]["revenue_item"] == "Cost Of Revenue"
    assert got["A", "q"]["net_income_item"] == "Net Income Common"
    assert got["A", "q"]["operating_income_item"] == "OPERATING INCOME"
    assert got["B", "q"]["net_income_item"] is None


def test_wide_keeps_slots_of_missing_values(spark):
    wide = {r["symbol"]: r for r in f.fundamentals_wide(sample(spark)).collect()}
    a = wide["A"]
    assert [a[f"q{i}_net_income"] for i in range(1, 6)] == [1.0, None, None, 0.5, None]
    assert [a[f"q{i}_revenue"] for i in range(1, 4)] == [4.0, 3.0, None]
    assert [a[f"q{i}_date"] for i in (1, 2, 5)] == [date(2024, 3, 31), date(2023, 12, 31), None]
    assert (a["y1_revenue"], a["y1_net_income"], a["y1_year"]) == (40.0, None, None)
    assert (wide["B"]["q1_revenue"], wide["B"]["q1_date"]) == (7.0, None)
    assert len(f.fundamentals_wide(sample(spark)).columns) == 1 + 12 * 4 + 5 * 3


def test_wide_takes_the_newest_twelve_quarters(spark):
    data = [("A", "q", "Net Income", 1, str(date(2010 + k // 4, 3 * (k % 4) + 1, 1)), float(k)) for k in range(20)]
    row = f.fundamentals_wide(statements(spark, data)).first()
    assert [row[f"q{i}_net_income"] for i in range(1, 13)] == [float(k) for k in range(19, 7, -1)]


def test_statements_from_wide(spark):
    matrix = spark.createDataFrame(
        [("A", "Net Income", 0, 1.0, None)], "symbol string, item string, item_pos int, `2024-03-31` double, `2023-12-31` double"
    )
    assert rows(f.statements_from_wide(matrix, "q").select("symbol", "freq", "period_end", "value")) == [
        ("A", "q", date(2023, 12, 31), None), ("A", "q", date(2024, 3, 31), 1.0),
    ]


def test_growth_needs_the_exact_earlier_period(spark):
    data = [("A", "2023-03-31", 10.0), ("A", "2024-03-31", 15.0), ("A", "2024-06-30", 5.0), ("B", "2023-03-31", 0.0), ("B", "2024-03-31", 1.0)]
    df = spark.createDataFrame(data, "symbol string, p string, value double").select("symbol", F.col("p").cast("date").alias("period_end"), "value")
    got = {(r["symbol"], str(r["period_end"])): r["growth"] for r in f.growth(df, 4, "quarter").collect()}
    assert got["A", "2024-03-31"] == 0.5
    assert got["A", "2024-06-30"] is None and got["A", "2023-03-31"] is None and got["B", "2024-03-31"] is None
    assert rows(f.growth(df.filter("value > 5"), 1, "year").select("growth")) == [(0.5,), (None,)]


def test_margins(spark):
    got = {(r["symbol"], r["freq"], str(r["period_end"])): r for r in f.margins(sample(spark)).collect()}
    assert got["A", "q", "2024-03-31"]["profit_margin"] == 0.25
    assert got["A", "q", "2024-03-31"]["operating_margin"] == 0.5
    assert got["A", "q", "2023-06-30"]["profit_margin"] is None


def test_summary_sorts_bad_caps_last(spark):
    table = spark.createDataFrame(
        [("A", "N/A", "T", 1), ("B", "5", "T", 1), ("C", "70", "T", 1), ("D", None, "T", 1)],
        "symbol string, marketCap string, sector string, other int",
    )
    got = f.fundamentals_summary(table)
    assert got.columns == ["symbol", "sector", "marketCap"]
    assert [r["symbol"] for r in got.collect()] == ["C", "B", "A", "D"]
    assert "pegRatio" in f.missing_summary_columns(table)


def quarters(spark, values):
    cols = [f"q{i}_net_income" for i in range(1, 9)] + [f"q{i}_revenue" for i in range(1, 9)]
    padded = list(values) + [None] * (8 - len(values))
    return spark.createDataFrame([(*padded, *padded)], ", ".join(f"{c} double" for c in cols))


@pytest.mark.parametrize(
    "values, expected",
    [
        ([4.0, 2.0, 2.0, 2.0], 50.0),
        ([4.0, None, 2.0, None, 2.0, 2.0, 100.0], 50.0),
        ([1.0, 1.0, -1.0, -1.0], 200.0),
        ([1.0, 1.0, 1.0, -1.0], None),
        ([1.0, 1.0, 1.0], None),
    ],
)
def test_acceleration(spark, values, expected):
    row = s.growth_acceleration(quarters(spark, values)).first()
    assert row["earnings_acceleration"] == expected and row["revenue_acceleration"] == expected


NAMES = ["earningsQuarterlyGrowth", "earningsGrowth", "returnOnEquity", "shortPercentOfFloat", "heldPercentInstitutions", "marketCap", "numberOfAnalystOpinions"]


def companies(spark, *data):
    return spark.createDataFrame([(f"S{i}", *d) for i, d in enumerate(data)], "symbol string, " + ", ".join(f"{n} double" for n in NAMES))


def test_score(spark):
    table = companies(
        spark,
        (0.30, 0.25, 0.20, 0.05, 0.50, 3e9, 5.0),
        (0.25, 0.20, 0.15, 0.10, 0.81, 2e9, 2.0),
        (None,) * 7,
        (-1.0, 0.0, 0.0, 0.20, 0.20, 3e8, 0.0),
        (0.05, 0.05, 0.16, 0.19, 0.40, 4e8, 1.0),
    )
    got = {r["symbol"]: r for r in s.score(table).collect()}
    assert [got[f"S{i}"]["canslim_score"] for i in range(5)] == [87, 15 + 10 + 7 + 5 + 3 + 5 + 5, 7, 7, 5 + 8 + 7 + 12 + 5 + 5]
    assert got["S0"]["canslim_score_percentage"] == 87.0
    assert [r["symbol"] for r in s.top(s.score(table), 2).collect()] == ["S0", "S1"]


def test_screen_and_funnel(spark):
    table = companies(
        spark,
        (0.30, 0.25, 0.20, 0.05, 0.50, 3e9, 5.0),
        (0.30, None, 0.20, 0.05, 0.50, 3e9, 5.0),
        (0.20, 0.25, 0.20, 0.05, 0.50, 3e9, 5.0),
        (0.21, 0.16, 0.20, None, 0.50, 3e9, 5.0),
    )
    assert rows(s.screen(table).select("symbol")) == [("S0",)]
    assert rows(s.screen(table.drop("shortPercentOfFloat")).select("symbol")) == [("S0",), ("S3",)]
    assert s.screen(table.select("symbol")).count() == 4
    assert [tuple(r) for r in s.funnel(table).orderBy("step").collect()] == [
        (1, "earningsQuarterlyGrowth", 3, 4, 3),
        (2, "earningsGrowth", 3, 3, 2),
        (3, "shortPercentOfFloat", 3, 3, 1),
        (4, "marketCap", 4, 4, 1),
    ]
    assert "Exchange" not in s.screen(s.score(table))._jdf.queryExecution().executedPlan().toString()
