"""Files in, tables out: sources, sinks, whole jobs and the stream."""

import json
from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.operators.trailing import moving_averages
from quoteloom.operators.universe import build_universe
from quoteloom.plans import batch, bulk, fundamentals, history, universe
from quoteloom.plans.info import run_clean_lists
from quoteloom.schemas import BARS, REJECTS
from quoteloom.session import shared_dir, stage
from quoteloom.sinks import tables
from quoteloom.sources import bulk as bulk_source
from quoteloom.sources import files, lists
from quoteloom.sources import history as history_source
from quoteloom.streaming.bulk_stream import stream_bulk_files

STOCKS = "Symbol, Description ,High 1 day,Low 1 day,Open 1 day,Price,Volume 1 day"
FUNDS = "Symbol,Description,Focus,Open 1 day,High 1 day,Low 1 day,Volume 1 day,Price"


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def symbols(spark, *names):
    return spark.createDataFrame([(n, i) for i, n in enumerate(names)], "symbol string, pos bigint")


def bulk_folder(tmp_path):
    put(tmp_path / "stocks_2025-10-01.csv", STOCKS,
        "AAPL,Apple,186.86,182.35,185.58,184.08,82488700", "BRK.A,B,,,1.0,2.0,3.9", "X/PR,P,1,1,1,1,1",
        "BAD1,x,1,1,,1,1", "BAD2,x,oops,1,1,1,1", "BAD3,x,1,1,1,1,inf", "TWICE,x,1,1,1,1,1", "TWICE,x,2,2,2,2,2")
    put(tmp_path / "zfunds_2025-10-01.csv", FUNDS, "SPY,Fund,Large,10,12,9,100,11", "AAPL,dup,f,1,1,1,1,1")
    put(tmp_path / "stocks_2025-09-30.csv", STOCKS, "AAPL,Apple,1,1,1,1,1", "OLD,o,1,1,1,1,1")
    put(tmp_path / "broken_2025-13-45.csv", STOCKS, "AAPL,Apple,1,1,1,1,1")
    put(tmp_path / "other_2025-10-01.csv", "Symbol,Price", "NOPE,1")
    put(tmp_path / "notes_2025-10-02.txt", "x")
    return str(tmp_path)


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3).toDF("n"))
    assert shared_dir(spark) in staged.inputFiles()[0] and staged.count() == 3


def test_symbol_lists(spark, tmp_path):
    a = put(tmp_path / "a" / "sp500_tickers.csv", "ticker", "MSFT", "AAPL", "NA", "MSFT", '""')
    b = put(tmp_path / "b" / "etf_tickers.csv", "Symbol,Sector", "SPY,x", "AAPL,y")
    assert [r["symbol"] for r in lists.read_symbols(spark, a).orderBy("pos").collect()] == ["MSFT", "AAPL", "NA", "MSFT"]
    assert rows(lists.read_symbols(spark, b).select("symbol")) == [("AAPL",), ("SPY",)]
    both = lists.read_choice(spark, "1-7", [str(tmp_path / "a"), str(tmp_path / "b")])
    assert [r["symbol"] for r in both.orderBy("pos").collect()] == ["MSFT", "AAPL", "NA", "SPY"]
    with pytest.raises(FileNotFoundError):
        lists.read_choice(spark, 8, [str(tmp_path / "a")])
    with pytest.raises(ValueError):
        lists.read_symbols(spark, put(tmp_path / "c.csv", "name", "x"))
    wide = put(tmp_path / "i.csv", "ticker,,,", "^GSPC,S&P 500,,x", "^DJI,,,")
    assert rows(lists.read_symbols(spark, wide).select("symbol")) == [("^DJI",), ("^GSPC",)]


def test_first_existing_and_missing_tables(spark, tmp_path):
    here = put(tmp_path / "x.csv", "a", "1")
    assert files.first_existing(spark, [str(tmp_path / "no"), here]) == here
    with pytest.raises(FileNotFoundError):
        files.first_existing(spark, [str(tmp_path / "no")])
    assert files.read_table(spark, str(tmp_path / "no"), BARS).count() == 0


def test_latest_files(spark, tmp_path):
    day, paths = bulk_source.latest_files(spark, bulk_folder(tmp_path))
    assert day == date(2025, 10, 1)
    assert [p.rsplit("/", 1)[1] for p in paths] == ["other_2025-10-01.csv", "stocks_2025-10-01.csv", "zfunds_2025-10-01.csv"]
    (tmp_path / "empty").mkdir()
    assert bulk_source.latest_files(spark, str(tmp_path / "empty")) == (None, [])


def test_bulk_rows_by_header(spark, tmp_path):
    _, paths = bulk_source.latest_files(spark, bulk_folder(tmp_path))
    got = bulk_source.last_written(bulk_source.read_bulk(spark, paths))
    day = date(2025, 10, 1)
    assert rows(got) == [
        (day, "AAPL", 1.0, 1.0, 1.0, 1.0, 1), (day, "BRK-A", 1.0, None, None, 2.0, 3),
        (day, "SPY", 10.0, 12.0, 9.0, 11.0, 100), (day, "TWICE", 2.0, 2.0, 2.0, 2.0, 2),
    ]
    golden = bulk_source.read_bulk(spark, [p for p in paths if "stocks" in p]).filter("symbol = 'AAPL'").first()
    assert tuple(golden)[:7] == (day, "AAPL", 185.58, 186.86, 182.35, 184.08, 82488700)
    assert bulk_source.read_bulk(spark, []).count() == 0


ODD_NAMES = ["All stocks _OHLCV_2025-10-01.csv", "a#b_2025-10-01.csv", "c%20d_2025-10-01.csv", "e+f[1]_2025-10-01.csv"]


def test_file_names_with_odd_characters(spark, tmp_path):
    for k, name in enumerate(ODD_NAMES):
        put(tmp_path / name, STOCKS, f"S{k},s,1,1,1,1,1", f"ALL,s,1,1,1,{k}.5,1")
    _, paths = bulk_source.latest_files(spark, str(tmp_path))
    got = bulk_source.read_bulk(spark, paths)
    assert rows(got.select("file_name").distinct()) == sorted((n,) for n in ODD_NAMES)
    last = bulk_source.last_written(got)
    assert {r["symbol"] for r in last.collect()} == {"ALL", "S0", "S1", "S2", "S3"}
    assert last.filter("symbol = 'ALL'").first()["close"] == max(range(4), key=lambda k: ODD_NAMES[k]) + 0.5


def test_history_names_with_odd_characters(spark, tmp_path):
    for name in ("^GSPC", "BRK B", "A+B", "50%", "x#y"):
        put(tmp_path / f"{name}.csv", "Date,Close", "2025-01-02,1")
    got = history_source.read_history_folder(spark, str(tmp_path))
    assert {r["symbol"] for r in got.collect()} == {"^GSPC", "BRK B", "A+B", "50%", "x#y"}


def test_headers_of_any_kind(spark, tmp_path):
    wide = ",".join(f"column number {k:06d}" for k in range(7000))
    put(tmp_path / "wide_2025-10-01.csv", f"{wide},{STOCKS}", "," * 7000 + "WIDE,w,1,1,1,1,1")
    put(tmp_path / "twice_2025-10-01.csv", f"{STOCKS},Symbol,symbol,\"quoted, name\"", 'TWO,"a ""b"", c",1,1,1,1,1,x,y,z')
    put(tmp_path / "accents_2025-10-01.csv", STOCKS, "É" * 40000 + ",e,1,1,1,1,1")
    (tmp_path / "nothing_2025-10-01.csv").write_text("")
    _, paths = bulk_source.latest_files(spark, str(tmp_path))
    got = {r["symbol"] for r in bulk_source.read_bulk(spark, paths).collect()}
    assert {"WIDE", "TWO"} <= got
    (raw,) = [r.fields for r in files.read_csv(spark, paths).collect() if r.file_name.startswith("twice")]
    assert raw["quoted, name"] == "z" and raw["symbol"] == "y" and 'a "b", c' in raw.values()


def test_empty_folder(spark, tmp_path):
    assert history_source.read_history_folder(spark, str(tmp_path)).count() == 0
    assert history_source.read_dated_folder(spark, str(tmp_path)).count() == 0


def test_bulk_merge_and_backfill(spark, tmp_path):
    folder, store = bulk_folder(tmp_path / "in"), str(tmp_path / "bars")
    asked = symbols(spark, "AAPL", "SPY", "BRK-A", "OLD")
    rejects = str(tmp_path / "rejects")
    counts = bulk.run_latest_bulk(spark, folder, asked, store, rejects_path=rejects)
    assert rows(counts) == [("added", 3)]
    assert rows(files.read_table(spark, rejects, REJECTS).select("symbol", "source", "interval", "reason", "first_seen")) == [
        ("OLD", "bulk", "1d", "no valid row", date(2025, 10, 1)),
    ]
    again = bulk.run_latest_bulk(spark, folder, asked, store)
    assert rows(again) == [("already stored", 3)]
    assert rows(bulk.run_backfill(spark, folder, asked, store)) == [("added", 2), ("already stored", 3)]
    stored = history_source.read_bars(spark, store, "1d")
    assert rows(stored.select("date", "symbol")) == [
        (date(2025, 9, 30), "AAPL"), (date(2025, 9, 30), "OLD"), (date(2025, 10, 1), "AAPL"),
        (date(2025, 10, 1), "BRK-A"), (date(2025, 10, 1), "SPY"),
    ]
    assert bulk.run_latest_bulk(spark, str(tmp_path), None, store) is None


def test_stream_equals_batches(spark, tmp_path):
    folder = bulk_folder(tmp_path / "in")
    expected = str(tmp_path / "expected")
    bulk.run_backfill(spark, folder, None, expected)
    streamed = str(tmp_path / "streamed")

    def run(checkpoint):
        stream_bulk_files(spark, folder, None, streamed, str(tmp_path / checkpoint)).awaitTermination()
        return rows(history_source.read_bars(spark, streamed).drop("source"))

    first = run("c1")
    assert first == rows(history_source.read_bars(spark, expected).drop("source"))
    put(tmp_path / "in" / "late_2025-09-01.csv", STOCKS, "LATE,l,1,1,1,1,1")
    second = run("c1")
    assert len(second) == len(first) + 1
    assert run("c2") == second


@pytest.mark.parametrize("files_per_batch", [1, 2, 100])
def test_stream_does_not_depend_on_batches(spark, tmp_path, files_per_batch):
    folder = tmp_path / "in"
    for k, name in enumerate(["b", "a", "c c"]):
        put(folder / f"{name}_2025-10-01.csv", STOCKS, f"AAPL,a,1,1,1,{k + 1}.0,1", f"{name[0].upper()},x,1,1,1,1,1")
    put(folder / "a_2025-09-30.csv", STOCKS, "OLD,a,1,1,1,5.0,1")
    store, expected = str(tmp_path / "streamed"), str(tmp_path / "expected")
    old = spark.createDataFrame([("OLD", date(2025, 9, 30), 4.0)], "symbol string, date date, close double")
    for path in (store, expected):
        tables.append_bars(tables.as_bars(old, "1d", "history"), path)
    bulk.run_backfill(spark, str(folder), None, expected)
    stream_bulk_files(spark, str(folder), None, store, str(tmp_path / "c"), files_per_batch=files_per_batch).awaitTermination()
    assert rows(history_source.read_bars(spark, store)) == rows(history_source.read_bars(spark, expected))


def test_replacing_by_nothing(spark, tmp_path):
    path = str(tmp_path / "rejects")
    row = spark.createDataFrame([("A", "bulk", "1d", "x", None)], REJECTS)
    tables.replace_rejects(row, path, "bulk", "1d")
    tables.replace_rejects(row, path, "history", "1d")
    tables.replace_rejects(row.limit(0), path, "bulk", "1d")
    assert rows(files.read_table(spark, path, REJECTS).select("source")) == [("history",)]
    lists = spark.createDataFrame([("B", 2, "g"), ("A", 1, "g"), ("C", 1, "h")], "symbol string, pos long, group string")
    tables.write_lists(lists, str(tmp_path / "lists"))
    tables.write_lists(lists.filter("group = 'g'"), str(tmp_path / "lists"))
    got = spark.read.parquet(str(tmp_path / "lists"))
    assert [r["symbol"] for r in got.orderBy("pos").collect()] == ["A", "B"]


def test_a_crash_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "series")
    tables.write_series(spark.createDataFrame([(date(2024, 1, 1), 0.5)], "date date, ratio double"), path)
    (tmp_path / "series" / "version=2").mkdir()  # a run that never came to its end
    assert rows(files.read_table(spark, path, "date date, ratio double")) == [(date(2024, 1, 1), 0.5)]
    tables.write_series(spark.createDataFrame([(date(2024, 1, 2), 0.6)], "date date, ratio double"), path)
    assert rows(files.read_table(spark, path, "date date, ratio double")) == [(date(2024, 1, 2), 0.6)]


def test_sources_keep_their_bars(spark, tmp_path):
    store = str(tmp_path / "bars")
    bar = spark.createDataFrame([("A", date(2024, 1, 1), 1.0)], "symbol string, date date, close double")
    tables.append_bars(tables.as_bars(bar, "1d", "bulk"), store)
    tables.replace_dates(tables.as_bars(bar, "1d", "batch"), store)
    assert rows(history_source.read_bars(spark, store).select("source")) == [("batch",), ("bulk",)]


def test_history_folder_with_mixed_suffixes(spark, tmp_path):
    put(tmp_path / "AAPL.csv", "Date,Open,High,Low,Close,Volume", "2025-03-03 00:00:00-05:00,1,2,0.5,1.5,10", "2025-09-05 00:00:00-04:00,2,3,1.5,2.5,20")
    put(tmp_path / "BRK-B.csv", "Date,Close,Volume,sector", "2025-09-05,N/A,7.9,Fin")
    got = history_source.read_history_folder(spark, str(tmp_path))
    assert rows(got.select("symbol", "date", "suffix", "close", "volume")) == [
        ("AAPL", date(2025, 3, 3), "-05:00", 1.5, 10), ("AAPL", date(2025, 9, 5), "-04:00", 2.5, 20),
        ("BRK-B", date(2025, 9, 5), None, None, 7),
    ]


def test_dated_folder_ratio_and_reject_files(spark, tmp_path):
    put(tmp_path / "d" / "prices_1d_2024-01-02.csv", "Date,Symbol,Open,High,Low,Close,Adj Close,Volume", "2024-01-02,A,1,2,0.5,1.5,1.4,10.0", "2024-01-02,NA,1,1,1,,,")
    put(tmp_path / "d" / "prices_1d_2024-01-03.csv", "Date,Symbol,Close,Volume", "2024-01-03,A,2.5,7")
    got = history_source.read_dated_folder(spark, str(tmp_path / "d"))
    assert rows(got.select("date", "symbol", "close", "adj_close", "volume")) == [
        (date(2024, 1, 2), "A", 1.5, 1.4, 10), (date(2024, 1, 2), "NA", None, None, None), (date(2024, 1, 3), "A", 2.5, None, 7),
    ]
    ratio = history_source.read_ratio_csv(spark, put(tmp_path / "r.csv", "Date,EPC_Ratio", "2024-01-02,0.62", "2024-01-03,"))
    assert rows(ratio) == [(date(2024, 1, 2), 0.62), (date(2024, 1, 3), None)]
    one = history_source.read_rejects_csv(spark, put(tmp_path / "b.csv", "Symbol,Date", "A,2024-01-02"), "batch", "1d")
    two = history_source.read_rejects_csv(spark, put(tmp_path / "t.csv", "ticker,error,timeframe", "B,bad,weekly"), "bulk")
    assert rows(one.unionByName(two)) == [("A", "batch", "1d", None, date(2024, 1, 2)), ("B", "bulk", "weekly", "bad", None)]


def test_writes_are_rebalanced(spark):
    df = spark.range(5).select(F.lit("1d").alias("interval"), F.lit(None).cast("date").alias("date"))
    assert "RebalancePartitions" in tables._spread(df, ["interval", "date"])._jdf.queryExecution().optimizedPlan().toString()


def test_replacing_dates_keeps_the_others(spark, tmp_path):
    store = str(tmp_path / "bars")

    def bars(*data):
        df = spark.createDataFrame(list(data), "symbol string, date string, close double").withColumn("date", F.col("date").cast("date"))
        return tables.as_bars(df, "1d", "batch")

    tables.replace_dates(bars(("A", "2024-01-01", 1.0), ("B", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0)), store)
    tables.replace_dates(bars(("A", "2024-01-02", 3.0)), store)
    tables.replace_dates(tables.as_bars(bars(("A", "2024-01-02", 9.0)), "1wk", "batch"), store)
    assert rows(history_source.read_bars(spark, store, "1d").select("date", "symbol", "close")) == [
        (date(2024, 1, 1), "A", 1.0), (date(2024, 1, 1), "B", 1.0), (date(2024, 1, 2), "A", 3.0),
    ]
    assert history_source.read_bars(spark, store).count() == 4
    assert rows(history_source.read_bars(spark, store).select("source").distinct()) == [("batch",)]


def test_bucketed_history_needs_no_shuffle(spark, tmp_path):
    data = [(s, date(2024, 1, d), float(d), d) for s in "ABCDE" for d in range(1, 9)]
    bars = spark.createDataFrame(data, "symbol string, date date, close double, volume bigint")
    tables.write_history_buckets(bars, "bucketed_bars", str(tmp_path / "b"), 4)
    try:
        stored = spark.table("bucketed_bars")
        got = moving_averages(stored)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert rows(got) == rows(moving_averages(bars))
    finally:
        spark.sql("DROP TABLE bucketed_bars")


def test_export_csv(spark, tmp_path):
    df = spark.createDataFrame([("1d", "A", 1.5), ("1wk", "B", None)], "interval string, symbol string, close double")
    tables.export_csv(df, str(tmp_path / "x"), ["interval"])
    lines = [p.read_text() for p in sorted((tmp_path / "x" / "interval=1d").glob("*.csv"))]
    assert lines == ["symbol,close\nA,1.5\n"]
    tables.export_csv(df.drop("interval"), str(tmp_path / "y"))
    assert spark.read.csv(str(tmp_path / "y"), header=True).count() == 2


def landed(spark, *data):
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "symbol string, date string, close double, pos bigint")
    return df.withColumn("date", F.col("date").cast("date"))


def test_batch_job(spark, tmp_path):
    store, rejects = str(tmp_path / "bars"), str(tmp_path / "rejects")
    asked = symbols(spark, "A", "B.C", "A", "X/Y", "GONE")
    daily = landed(spark, ("A", "2024-01-02", 1.0), ("A", "2024-01-02", 9.0), ("B-C", "2024-01-02", None), ("Z", "2024-01-02", 1.0), ("A", "2023-01-01", 1.0))
    weekly = landed(spark, ("B-C", "2024-01-01", 4.0))
    ranges = {"1d": ("2024-01-01", "2024-02-01", "max")}
    counts = batch.run_batch(spark, {"1d": daily, "1wk": weekly}, asked, store, rejects, date(2024, 1, 3), ranges=ranges)
    assert tuple(counts["1d"].first()) == (1, 1)
    assert rows(history_source.read_bars(spark, store).select("interval", "symbol", "close")) == [("1d", "A", 1.0), ("1wk", "B-C", 4.0)]
    known = rows(files.read_table(spark, rejects, batch.BATCH_REJECTS))
    assert known == [("B-C", date(2024, 1, 3)), ("GONE", date(2024, 1, 3))]
    batch.run_batch(spark, {"1d": daily}, asked, store, rejects, date(2024, 1, 9), use_rejects=False)
    assert rows(files.read_table(spark, rejects, batch.BATCH_REJECTS)) == known
    nothing = landed(spark, ("Q", "2024-01-02", 1.0))
    batch.run_batch(spark, {"1d": nothing}, symbols(spark, "NEW"), store, rejects, date(2024, 1, 9))
    assert files.read_table(spark, rejects, batch.BATCH_REJECTS).filter("symbol = 'NEW'").count() == 0


@pytest.mark.parametrize("most", [2, 1000])
def test_batch_bars_are_written_once(spark, tmp_path, monkeypatch, request, most):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    request.addfinalizer(lambda before=spark.conf.get(name): spark.conf.set(name, before))
    spark.conf.set(name, "false")
    monkeypatch.setattr(tables, "ROWS_A_PART", most)
    staged = []
    monkeypatch.setattr(batch, "stage", lambda df, name: staged.append(name) or stage(df, name))
    store, rejects = str(tmp_path / "bars"), str(tmp_path / "rejects")
    names = [f"S{k}" for k in range(20)]
    days = ["2024-01-02"] * 3 + ["2024-01-03", None]
    given = [(n, d, float(10 * k + j)) for k, n in enumerate(names) for j, d in enumerate(days)]
    found = landed(spark, *given, ("S1", "2024-01-04", None), ("Z", "2024-01-05", 1.0)).repartition(3)
    for _ in range(2):
        counts = batch.run_batch(spark, {"1d": found}, symbols(spark, *names, "GONE"), store, rejects, date(2024, 1, 9), use_rejects=False)
    assert "bars" not in staged and tuple(counts["1d"].first()) == (2, 20)
    want = {(n, date.fromisoformat(days[j]), float(10 * k + j)) for k, n in enumerate(names) for j in (0, 3)}  # no date is in no period
    stored = history_source.read_bars(spark, store, "1d").select("symbol", "date", "close")
    assert stored.count() == len(want) and {tuple(r) for r in stored.collect()} == want
    assert rows(files.read_table(spark, rejects, batch.BATCH_REJECTS)) == [("GONE", date(2024, 1, 9))]
    parts = list((tmp_path / "bars" / "interval=1d" / "source=batch" / "date=2024-01-02").glob("*.parquet"))
    assert (len(parts) > 1) == (most == 2)  # a large date is dealt to several tasks


def test_history_of_new_dates_is_not_merged(spark, tmp_path, monkeypatch):
    store, rejects, clean = (str(tmp_path / n) for n in ("bars", "rejects", "clean"))
    staged = []
    monkeypatch.setattr(history, "stage", lambda df, name: staged.append(name) or stage(df, name))
    deliveries = [[], [("A", "2024-01-01", 1.0)], [("A", "2024-01-02", 2.0)], [("B", "2024-01-02", 3.0), ("A", "2024-01-03", 4.0)]]
    merges, wanted = [], set()
    for bars in deliveries:
        staged.clear()
        found = landed(spark, *(bars or [("Z", "2024-01-01", 0.0)]))  # nobody asked for Z
        written = history.run_history(spark, symbols(spark, "A", "B"), found, store, "1d", rejects, clean, date(2024, 1, 9))
        merges.append("merged" in staged)
        wanted |= {(s, date.fromisoformat(d), c) for s, d, c in bars}
        assert {tuple(r) for r in written.select("symbol", "date", "close").collect()} <= wanted
        assert set(rows(history_source.read_bars(spark, store, "1d").select("symbol", "date", "close"))) == wanted
    assert merges == [False, False, False, True]


def test_history_job(spark, tmp_path):
    store, rejects, clean = (str(tmp_path / n) for n in ("bars", "rejects", "clean"))
    asked = symbols(spark, "A", "B", "GONE")
    args = (store, "1d", rejects, clean, date(2024, 1, 9))
    history.run_history(spark, asked, landed(spark, ("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0), ("Z", "2024-01-02", 1.0)), *args)
    errors = spark.createDataFrame([("GONE", "404")], "symbol string, reason string")
    history.run_history(spark, asked, landed(spark, ("A", "2024-01-02", 99.0), ("A", "2024-01-03", 3.0), ("B", "2024-01-02", 5.0)), *args, errors=errors)
    assert rows(history_source.read_bars(spark, store, "1d").select("date", "symbol", "close")) == [
        (date(2024, 1, 1), "A", 1.0), (date(2024, 1, 2), "A", 2.0), (date(2024, 1, 2), "B", 5.0), (date(2024, 1, 3), "A", 3.0),
    ]
    assert rows(spark.read.parquet(clean)) == [("A",), ("B",)]
    assert rows(files.read_table(spark, rejects, REJECTS).select("symbol", "reason", "source", "interval")) == [("GONE", "404", "history", "1d")]


def test_weekly_history_rereads_its_last_label(spark, tmp_path):
    store, rejects, clean = (str(tmp_path / n) for n in ("bars", "rejects", "clean"))
    args = (store, "1wk", rejects, clean, date(2024, 1, 9))
    history.run_history(spark, symbols(spark, "A"), landed(spark, ("A", "2024-01-01", 1.0)), *args)
    history.run_history(spark, symbols(spark, "A"), landed(spark, ("A", "2024-01-01", 1.5), ("A", "2024-01-08", 2.0)), *args)
    assert rows(history_source.read_bars(spark, store, "1wk").select("date", "close")) == [(date(2024, 1, 1), 1.5), (date(2024, 1, 8), 2.0)]


def test_history_state_follows_the_table(spark, tmp_path):
    store, rejects, clean, state = (str(tmp_path / n) for n in ("bars", "rejects", "clean", "state"))
    args = (store, "1d", rejects, clean, date(2024, 1, 9))
    steps = [
        [("A", "2024-01-01", 1.0), ("B", "2024-01-05", 1.0)],
        [("A", "2024-01-01", 9.0), ("A", "2024-01-03", 3.0), ("B", "2024-01-04", 9.0)],
        [("C", "2024-01-02", 5.0)],
    ]
    for step in steps:
        history.run_history(spark, symbols(spark, "A", "B", "C"), landed(spark, *step), *args, state_path=state)
        stored = history_source.read_bars(spark, store, "1d")
        kept = files.read_table(spark, f"{state}/interval=1d", history.LAST_DATES)
        assert rows(kept) == rows(history.latest_dates(stored))
    assert rows(stored.select("symbol", "date", "close")) == [
        ("A", date(2024, 1, 1), 1.0), ("A", date(2024, 1, 3), 3.0), ("B", date(2024, 1, 5), 1.0), ("C", date(2024, 1, 2), 5.0),
    ]
    assert rows(spark.read.parquet(clean)) == [("A",), ("B",), ("C",)]


UNIVERSE = [
    "Symbol,Description,Market capitalization,Sector,Index",
    'AAPL,Apple,3000,Tech,"S&P 500, NASDAQ 100"', 'BRK.A,Berkshire,900,Fin,"S&P 500,"', "SMALL,Small,1,Tech,Russell 2000", "X/PR,Pref,1,Fin,S&P 500",
]


def test_universe_job_and_choices(spark, tmp_path):
    built = universe.run_universe(spark, put(tmp_path / "u.csv", *UNIVERSE), str(tmp_path / "out"))
    flags = spark.read.parquet(str(tmp_path / "out" / "flags"))
    assert rows(flags.select("symbol", "SP500", "Russell2000")) == [("AAPL", True, False), ("BRK-A", True, False), ("SMALL", False, True)]
    assert rows(spark.read.parquet(str(tmp_path / "out" / "index_lists"))) == [
        ("AAPL", "NASDAQ100"), ("AAPL", "SP500"), ("BRK-A", "SP500"), ("SMALL", "Russell2000"),
    ]
    out = str(tmp_path / "choices")
    universe.run_choice(spark, "1-2", built, [], out)
    universe.run_choice(spark, "1-2", built, [], out)
    assert rows(spark.read.parquet(f"{out}/symbols").groupBy("choice").count()) == [("0", 3), ("1", 2), ("1-2", 2), ("2", 1)]
    info = spark.read.parquet(f"{out}/info/choice=2")
    assert info.first()["description"] == "Apple"
    put(tmp_path / "lists" / "test_tickers.csv", "ticker", "TSLA", "AAPL")
    universe.run_choice(spark, 8, built, [str(tmp_path / "lists")], out)
    listed = spark.read.parquet(f"{out}/info_clean/choice=8")
    assert [r["symbol"] for r in listed.orderBy("pos").collect()] == ["TSLA", "AAPL"]
    kinds = {str(spark.read.parquet(f"{out}/info/choice={c}").schema) for c in ("0", "1", "2", "1-2")}
    assert len(kinds) == 1


def test_lists_and_info_jobs(spark, tmp_path):
    built = build_universe(lists.read_universe(spark, put(tmp_path / "u.csv", *UNIVERSE)))
    directory = lists.read_directory(spark, put(tmp_path / "d.txt", "Header|Symbol|a|b|c|d|e|f", "Y|AAPL|Apple|Q|Q|N|100|N||", "Y|SPY|F|P||Y|100|N||"))
    page = "<table><tr><th>Symbol</th></tr><tr><td>MMM</td></tr></table>"
    pages = spark.createDataFrame([("http://x/List_of_S%26P_500_companies", page), ("http://x/List_of_S%26P_600_companies", page.replace("MMM", "AAP"))], "url string, html string")
    out = str(tmp_path / "out")
    universe.run_lists(spark, directory, pages, built, out, choice=2, own_lists={"portfolio": symbols(spark, "P")})
    stored = spark.read.parquet(f"{out}/lists")
    assert rows(stored.filter("group <> 'universe_clean'").select("symbol", "group")) == [
        ("AAP", "sp600"), ("AAPL", "nasdaq_all"), ("AAPL", "universe"), ("BRK-A", "universe"), ("MMM", "sp500"), ("P", "portfolio"), ("SMALL", "universe"),
    ]
    ordered = stored.filter("group = 'universe'").orderBy("pos")
    assert [r["symbol"] for r in ordered.collect()] == [r["symbol"] for r in built.orderBy("pos").collect()]
    assert rows(spark.read.parquet(f"{out}/provider_info/choice=2").select("symbol", "longName")) == [("AAPL", "Apple")]
    info = universe.run_info(built, symbols(spark, "AAPL", "SMALL"), 1, out)
    run_clean_lists(info, symbols(spark, "SMALL", "SMALL"), symbols(spark, "AAPL"), out)
    assert rows(spark.read.parquet(f"{out}/symbols_clean")) == [("SMALL",)]
    assert spark.read.parquet(f"{out}/portfolio_clean").count() == 0


def test_fundamentals_job(spark, tmp_path):
    docs = [{"symbol": "A", "marketCap": 4e8, "earningsGrowth": 0.3, "earningsQuarterlyGrowth": 0.3, "shortPercentOfFloat": 0.1}, {"symbol": "B", "marketCap": "N/A"}, {"symbol": "C"}]
    from quoteloom.operators.info import attributes_from_json

    attributes = attributes_from_json(lists.read_attributes(spark, put(tmp_path / "a.json", *[json.dumps(d) for d in docs])))
    statements = spark.createDataFrame([("A", "q", "Net Income", 1, date(2024, 3, 31), 5.0)], "symbol string, freq string, item string, item_pos bigint, period_end date, value double")
    statements.write.parquet(str(tmp_path / "s"))
    out = str(tmp_path / "out")
    fundamentals.run_fundamentals(attributes, history_source.read_statements(spark, str(tmp_path / "s")), symbols(spark, "A", "B"), datetime(2024, 5, 1, 9, 0), out, scored=True)
    full = spark.read.parquet(f"{out}/full")
    assert rows(full.select("symbol", "q1_net_income", "last_updated")) == [("A", 5.0, "2024-05-01 09:00:00"), ("B", None, "2024-05-01 09:00:00")]
    assert [r["symbol"] for r in spark.read.parquet(f"{out}/summary").collect()] == ["A", "B"]
    assert rows(spark.read.parquet(f"{out}/screened").select("symbol")) == [("A",)]
