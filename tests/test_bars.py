import time
from datetime import date, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.operators import bars, dedup, trailing
from quoteloom.operators.numbering import dense_positions

D = date


def make(spark, data, schema="symbol string, date string, open double, high double, low double, close double, volume bigint"):
    return spark.createDataFrame(data, schema).withColumn("date", F.col("date").cast("date"))


def test_bars_from_ticks_uses_the_order(spark):
    ticks = spark.createDataFrame(
        [("A", 2, 1, 5.0, 10), ("A", 1, 9, 7.0, 1), ("A", 1, 8, 6.0, 1), ("A", 3, 0, 1.0, 2), ("B", 1, 1, 2.0, 3)],
        "symbol string, ts bigint, seq bigint, price double, size bigint",
    )
    from quoteloom.functions.text import order_key

    got = bars.bars_from_ticks(ticks, ["symbol"], "price", "size", order_key(F.col("ts"), F.col("seq")))
    assert rows(got) == [("A", 6.0, 7.0, 1.0, 1.0, 14), ("B", 2.0, 2.0, 2.0, 2.0, 3)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_resample(spark):
    data = make(spark, [
        ("A", "2024-01-01", 1.0, 5.0, 0.5, 2.0, 10), ("A", "2024-01-05", 2.0, 6.0, 1.0, 3.0, 20),
        ("A", "2024-01-08", 9.0, 9.0, 8.0, 8.5, 5),
    ])
    assert rows(bars.resample(data, "week")) == [
        ("A", D(2024, 1, 1), 1.0, 6.0, 0.5, 3.0, 30), ("A", D(2024, 1, 8), 9.0, 9.0, 8.0, 8.5, 5),
    ]
    assert rows(bars.resample(data, "month")) == [("A", D(2024, 1, 1), 1.0, 9.0, 0.5, 8.5, 35)]
    with pytest.raises(ValueError):
        bars.resample(data, "year")


@pytest.mark.parametrize("field_first", [False, True])
def test_wide_to_long_both_level_orders(spark, field_first):
    def name(s, f):
        return f"{f}:{s}" if field_first else f"{s}:{f}"

    cols = ["Date"] + [name(s, f) for s in ("AAPL", "BRK-B") for f in ("Open", "Close", "Adj Close")]
    wide = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 2.5, 3.0, 4.0, 4.5), ("2024-01-03", 1.5, None, 2.5, 3.5, 4.5, None)],
        ", ".join(f"`{c}` {'string' if c == 'Date' else 'double'}" for c in cols),
    )
    got = bars.wide_to_long(wide)
    assert got.columns == ["date", "symbol", "open", "high", "low", "close", "adj_close", "volume"]
    assert rows(got.select("date", "symbol", "open", "close", "adj_close")) == [
        (D(2024, 1, 2), "AAPL", 1.0, 2.0, 2.5), (D(2024, 1, 2), "BRK-B", 3.0, 4.0, 4.5),
        (D(2024, 1, 3), "BRK-B", 3.5, 4.5, None),
    ]
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_wide_to_long_single_symbol(spark):
    wide = spark.createDataFrame([("2024-01-02", 1.0, 2.0), ("2024-01-03", 1.0, float("nan"))], "Date string, Open double, Close double")
    assert rows(bars.wide_to_long(wide, symbol="X").select("symbol", "close")) == [("X", 2.0)]
    with pytest.raises(ValueError):
        bars.wide_to_long(wide)


def test_date_range_is_half_open(spark):
    data = make(spark, [("A", d, 1.0, 1.0, 1.0, 1.0, 1) for d in ("2024-01-01", "2024-01-02", "2024-01-03")])
    assert bars.date_range(data, "2024-01-02", "2024-01-03").count() == 1
    assert bars.date_range(data, None, None).count() == 3
    assert bars.select_dates(data, "2024-01-02", None, "1d", "2024-01-01").count() == 2
    assert bars.select_dates(data, None, None, "1d", "2024-01-02").count() == 1


@pytest.mark.parametrize(
    "text, expected",
    [("1d", 1), ("2d", 2), ("1mo", 3), ("3mo", 4), ("1y", 6), ("ytd", 4), ("max", 7), ("10y", 7)],
)
def test_period(spark, text, expected):
    days = ["2022-01-01", "2023-06-30", "2023-12-29", "2024-03-31", "2024-05-31", "2024-06-27", "2024-06-30", "2024-07-05"]
    data = make(spark, [("A", d, 1.0, 1.0, 1.0, 1.0, 1) for d in days])
    assert bars.period(data, text, "2024-06-30").count() == expected


def test_period_days_counts_dates_of_the_whole_table(spark):
    data = make(spark, [("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1), ("B", "2024-01-02", 1.0, 1.0, 1.0, 1.0, 1)])
    assert rows(bars.period(data, "1d", "2024-06-30").select("symbol")) == [("B",)]


def test_batch_bars_first_landed_wins(spark):
    landed = spark.createDataFrame(
        [("A", "2024-01-01", None, 1), ("A", "2024-01-01", 2.0, 2), ("A", "2024-01-01", 3.0, 3), ("B", "2024-01-01", float("nan"), 1)],
        "symbol string, date string, close double, pos bigint",
    )
    assert rows(bars.batch_bars(landed, "pos").select("symbol", "close")) == [("A", 2.0)]


def test_keep_first_and_last_take_whole_rows(spark):
    df = spark.createDataFrame(
        [("k", 1, None, "x"), ("k", 2, 5, None), ("j", 7, 1, "z")], "k string, pos int, n int, s string"
    )
    assert rows(dedup.keep_first(df, ["k"], "pos")) == [("j", 7, 1, "z"), ("k", 1, None, "x")]
    assert rows(dedup.keep_last(df, ["k"], "pos")) == [("j", 7, 1, "z"), ("k", 2, 5, None)]
    assert rows(dedup.keep_last(df.drop("s"), ["k"], "pos")) == [("j", 7, 1), ("k", 2, 5)]
    files = df.withColumn("file", F.lit("f"))
    assert rows(dedup.keep_last(files, ["k"], ["file", "pos"]).select("k", "n")) == [("j", 1), ("k", 5)]
    assert rows(dedup.keep_first(df.select("k"), ["k"], "k")) == [("j",), ("k",)]


def test_latest_bar(spark):
    data = make(spark, [("A", "2024-01-01", 1.0, 1.0, 1.0, 1.0, 1), ("A", "2024-01-09", 2.0, 2.0, 2.0, 2.0, 2)])
    assert rows(bars.latest_bar(data)) == [("A", D(2024, 1, 9), 2.0, 2.0, 2.0, 2.0, 2)]


def history(spark):
    start = D(2023, 1, 2)
    data = []
    for s, n in (("A", 260), ("B", 3)):
        for k in range(n):
            p = float((k * 37) % 101) + 1
            data.append((s, start + timedelta(days=k * 3), p, p + 1, p - 1, p + 0.25, k + 1))
    return data, spark.createDataFrame(data, "symbol string, date date, open double, high double, low double, close double, volume bigint")


def test_trailing_values_against_loops(spark):
    data, df = history(spark)
    by_symbol = {}
    for r in data:
        by_symbol.setdefault(r[0], []).append(r)
    averages = {(r["symbol"], r["date"]): r for r in trailing.moving_averages(df).collect()}
    volumes = {(r["symbol"], r["date"]): r for r in trailing.average_volume(df).collect()}
    spans = {(r["symbol"], r["date"]): r for r in trailing.high_low(df).collect()}
    for s, series in by_symbol.items():
        for k, r in enumerate(series):
            key = (s, r[1])
            for n in (50, 200):
                part = series[max(0, k - n + 1): k + 1]
                assert averages[key][f"avg_{n}"] == pytest.approx(sum(x[5] for x in part) / len(part), abs=1e-9)
            part = series[max(0, k - 9): k + 1]
            assert volumes[key]["avg_volume_10"] == pytest.approx(sum(x[6] for x in part) / len(part))
            part = [x for x in series[: k + 1] if (r[1] - x[1]).days <= 364]
            assert spans[key]["high_52w"] == max(x[3] for x in part)
            assert spans[key]["low_52w"] == min(x[4] for x in part)


def test_trading_snapshot_is_the_last_trailing_row(spark):
    _, df = history(spark)
    snap = {r["symbol"]: r for r in trailing.trading_snapshot(df).collect()}
    for s in ("A", "B"):
        last = df.filter(F.col("symbol") == s).agg(F.max("date")).first()[0]
        here = (F.col("symbol") == s) & (F.col("date") == last)
        a = trailing.moving_averages(df).filter(here).first()
        h = trailing.high_low(df).filter(here).first()
        v = trailing.average_volume(df).filter(here).first()
        assert snap[s]["date"] == last
        assert (snap[s]["fiftyDayAverage"], snap[s]["twoHundredDayAverage"]) == (a["avg_50"], a["avg_200"])
        assert (snap[s]["fiftyTwoWeekHigh"], snap[s]["fiftyTwoWeekLow"]) == (h["high_52w"], h["low_52w"])
        assert snap[s]["averageDailyVolume10Day"] == v["avg_volume_10"]


def test_symbols_that_hold_the_separator(spark):
    df = spark.createDataFrame([("2024-01-02", 1.0, 2.0)], "Date string, `NYSE:IBM:Close` double, `Close:LSE:BP` double")
    assert rows(bars.wide_to_long(df).select("symbol", "close")) == [("LSE:BP", 2.0), ("NYSE:IBM", 1.0)]
    with pytest.raises(ValueError, match="no known field"):
        bars.wide_to_long(df.withColumnRenamed("NYSE:IBM:Close", "NYSE:IBM:Shut"))


def test_averages_skip_missing_values(spark):
    data = [("A", date(2024, 1, d), None, None, c, v) for d, c, v in ((1, 1.0, 100), (2, float("nan"), None), (3, 3.0, 100), (4, float("inf"), None), (5, 0.004, None))]
    df = spark.createDataFrame(data, "symbol string, date date, high double, low double, close double, volume bigint")
    assert [r["avg_50"] for r in trailing.moving_averages(df).orderBy("date").collect()] == [1.0, 1.0, 2.0, 2.0, pytest.approx(4.004 / 3)]
    assert [r["avg_volume_10"] for r in trailing.average_volume(df).orderBy("date").collect()] == [100.0] * 5
    newest = trailing.trading_snapshot(df)
    assert newest.first()["averageDailyVolume10Day"] == 100.0
    assert "WindowGroupLimit" in newest._jdf.queryExecution().executedPlan().toString()


def wide_file(spark, tmp_path, n):
    names = [f"{f}:S{k}" for k in range(n) for f in ("Open", "Close", "Volume")]
    cells = {n: [k, k + 1] if n.startswith("Vol") else [float(k), k + 1.0] for k, n in enumerate(names)}
    pq.write_table(pa.table({"Date": [D(2024, 1, 1), D(2024, 1, 2)], **cells}), tmp_path / "wide.parquet")
    return spark.read.parquet(str(tmp_path / "wide.parquet"))


def test_wide_to_long_of_thousands_of_symbols_plans_in_seconds(spark, tmp_path):
    wide = wide_file(spark, tmp_path, 6000)
    start = time.perf_counter()
    bars.wide_to_long(wide)._jdf.queryExecution().optimizedPlan()
    assert time.perf_counter() - start < 30


def test_wide_to_long_of_many_symbols(spark, tmp_path):
    got = bars.wide_to_long(wide_file(spark, tmp_path, 200))
    picked = got.where("symbol = 'S199'").select("date", "open", "close", "volume", "high")
    assert rows(picked) == [(D(2024, 1, 1 + d), 597.0 + d, 598.0 + d, 599.0 + d, None) for d in (0, 1)]


def test_wide_to_long_odd_names_and_types(spark):
    df = spark.createDataFrame([("2024-01-02", "1.5", 2, 3.0, None)], "Date string, `A``B:Close` string, `C.D:Close` int, `E\nF:Close` double, `G:Close` double")
    assert rows(bars.wide_to_long(df).select("symbol", "close")) == [("A`B", 1.5), ("C.D", 2.0), ("E\nF", 3.0)]


def test_frames_of_any_number_of_symbols_have_the_same_columns(spark):
    data = [(f"S{k}", D(2024, 1, 1 + k % 2), float(k), k) for k in range(23)] + [("S3", D(2024, 1, 5), None, 7)]
    long = spark.createDataFrame(data, "symbol string, date date, close double, volume bigint")
    symbols = dense_positions(long.select("symbol").distinct(), ["symbol"])
    wide = bars.long_to_frames(long, symbols, 4)
    assert len(wide.columns) == 2 + 4 * 2 == len(bars.long_to_frames(long.where("symbol < 'S2'"), symbols, 4).columns)
    assert wide.agg(F.max("frame")).first()[0] == 5
    got = bars.frames_to_long(wide, symbols, 4)
    assert got.columns == ["date", "symbol", "open", "high", "low", "close", "adj_close", "volume"]
    assert sorted(rows(got.select("symbol", "date", "close", "volume"))) == sorted((s, d, c, float(v)) for s, d, c, v in data if c is not None)
