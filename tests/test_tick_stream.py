"""Bars of a tick stream by event time against a loop over its arrivals."""

import os
import random
from datetime import datetime, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.streaming.tick_stream import as_ticks, closed_bars, late_ticks, open_bars, run_tick_stream, split_late

START = datetime(2024, 3, 1)


def _arrivals(seed: int, n: int = 4) -> list[list[tuple]]:
    draw, out = random.Random(seed), []
    for k in range(n):
        ticks = []
        for j in range(60):
            hour = draw.randrange(24 * (2 * k), 24 * (2 * k + 2)) if draw.random() < 0.8 else draw.randrange(24 * (2 * k + 2))
            ts = START + timedelta(hours=hour, minutes=draw.randrange(60))
            ticks.append((draw.choice("ABC"), ts, float(draw.randrange(100)), draw.randrange(9), k * 1000 + j))
        out.append(ticks)
    return out


def _expected(arrivals, delay=timedelta(days=1)):
    newest, days, late = None, {}, 0
    for ticks in arrivals:
        mark = newest and newest - delay
        for t in ticks:
            if t[1] is None or (mark and datetime(*t[1].timetuple()[:3]) + timedelta(days=1) <= mark):
                late += 1
            else:
                days.setdefault((t[0], t[1].date()), []).append(t)
        newest = max([t[1] for t in ticks if t[1]] + ([newest] if newest else []), default=None)
    bars = {}
    for key, ticks in days.items():
        ticks.sort(key=lambda t: t[4])
        prices = [t[2] for t in ticks]
        bars[key] = (prices[0], max(prices), min(prices), prices[-1], sum(t[3] for t in ticks), len(ticks))
    return bars, late, newest - delay if newest else None


@pytest.fixture
def arrive(spark, tmp_path):
    landed, store = str(tmp_path / "landed"), str(tmp_path / "store")
    schema = "symbol string, ts timestamp, price double, size bigint, k bigint"

    def send(ticks):
        df = spark.createDataFrame(ticks, schema).repartition(2)
        df.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        return as_ticks(stream, "price", "size", F.col("k")), store

    return send


def _bars(df):
    return {(r["symbol"], r["date"]): tuple(r)[2:] for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_bars_and_late_ticks_account_for_every_tick(spark, arrive, seed):
    arrivals = _arrivals(seed)
    for ticks in arrivals:
        run_tick_stream(*arrive(ticks))  # each call starts anew from the checkpoints
    store = arrive([])[1]
    bars, late, mark = _expected(arrivals)
    closed, still_open = _bars(closed_bars(spark, store)), _bars(open_bars(spark, store))
    assert late > 0 and late_ticks(spark, store).count() == late
    assert closed and still_open and not set(closed) & set(still_open)
    assert closed | still_open == bars
    ended = {k for k in bars if datetime(*k[1].timetuple()[:3]) + timedelta(days=1) <= mark}
    assert set(closed) == ended
    assert sum(b[5] for b in bars.values()) + late == sum(map(len, arrivals))


def test_a_call_without_new_ticks_changes_nothing(spark, arrive):
    arrivals = _arrivals(3, 2)
    for ticks in arrivals:
        stream, store = arrive(ticks)
        run_tick_stream(stream, store)
    before = rows(closed_bars(spark, store)), rows(open_bars(spark, store)), rows(late_ticks(spark, store))
    run_tick_stream(stream, store)
    assert before == (rows(closed_bars(spark, store)), rows(open_bars(spark, store)), rows(late_ticks(spark, store)))


@pytest.mark.parametrize("renamed", [True, False])
def test_a_batch_that_crashed_runs_again(spark, arrive, renamed):
    """The commit of the last batch is missing, as after a crash; its rows may or may not have appeared."""
    arrivals = _arrivals(4, 3)
    for ticks in arrivals[:2]:
        run_tick_stream(*arrive(ticks))
    stream, store = arrive(arrivals[2])
    split_late(stream, store, "1 day").awaitTermination()
    os.remove(f"{store}/checkpoints/split/commits/2")
    crc = f"{store}/checkpoints/split/commits/.2.crc"
    if os.path.exists(crc):
        os.remove(crc)
    if not renamed:
        os.rename(f"{store}/in_time/batch=2", f"{store}/arriving-left-over")
    run_tick_stream(stream, store)
    bars, late, _ = _expected(arrivals)
    assert late_ticks(spark, store).count() == late
    assert _bars(closed_bars(spark, store)) | _bars(open_bars(spark, store)) == bars


def test_ticks_without_time_are_late_and_other_nulls_count(spark, arrive):
    day = START + timedelta(hours=5)
    stream, store = arrive([("A", None, 1.0, 1, 1), ("A", day, None, None, 2), (None, day, 3.0, 4, 3)])
    run_tick_stream(stream, store)
    assert late_ticks(spark, store).count() == 1
    got = _bars(open_bars(spark, store))
    assert got == {("A", day.date()): (None,) * 5 + (1,), (None, day.date()): (3.0, 3.0, 3.0, 3.0, 4, 1)}
    assert closed_bars(spark, store).count() == 0
    stream, store = arrive([("B", day + timedelta(days=4), 1.0, 1, 1)])
    run_tick_stream(stream, store)
    assert set(_bars(closed_bars(spark, store))) == set(got)  # a bar without a symbol is not open and closed at once
    assert set(_bars(open_bars(spark, store))) == {("B", (day + timedelta(days=4)).date())}


def test_an_empty_folder(spark, arrive):
    stream, store = arrive([])
    run_tick_stream(stream, store)
    assert closed_bars(spark, store).count() == open_bars(spark, store).count() == late_ticks(spark, store).count() == 0
