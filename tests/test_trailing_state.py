"""Trailing values and bars kept up to date, against the full computation and plain loops."""

import random
from datetime import date, timedelta

import pytest
from helpers import rows
from pyspark.sql import functions as F

from quoteloom.functions.text import order_key
from quoteloom.operators import trailing
from quoteloom.operators.bars import bars_from_ticks
from quoteloom.operators.partials import bars_of, by_label, merge_partials, partial_bars
from quoteloom.operators.trailing_state import STATE, advance
from quoteloom.plans.ticks import read_tick_bars, run_ticks
from quoteloom.session import stage

DAY = date(2024, 1, 1)
BARS = "symbol string, date date, close double, volume bigint"


def history(seed, n=60):
    rng = random.Random(seed)
    out = []
    for s in "ABC":
        for k in sorted(rng.sample(range(3 * n), n)):
            close = None if rng.random() < 0.1 else float("nan") if rng.random() < 0.05 else rng.randint(1, 10**6) / 7
            out.append((s, DAY + timedelta(days=k), close, None if rng.random() < 0.1 else rng.randint(1, 1000)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_increments_equal_the_full_computation(spark, seed):
    rng = random.Random(seed)
    data = history(seed)
    dealt = [rng.randint(0, 3) for _ in data]
    state, values, seen = spark.createDataFrame([], STATE), {}, []
    for k in range(4):
        now = [r for r, d in zip(data, dealt) if d == k]
        if k == 3:  # some stored bars are delivered again with other values
            now += [(r[0], r[1], 5.0, 7) for r in rng.sample(seen, 3)]
        frame = lambda x: spark.createDataFrame(x, BARS)
        found, state = advance(state, frame(seen), frame(now), spans=(3, 8), volume_span=4)
        values |= {(r.symbol, r.date): r for r in found.collect()}
        state = stage(state, "state")
        seen = list({(r[0], r[1]): r for r in seen + now}.values())
    whole = spark.createDataFrame(seen, BARS)
    close = {(r.symbol, r.date): r for r in trailing.moving_averages(whole, (3, 8)).collect()}
    volume = {(r.symbol, r.date): r for r in trailing.average_volume(whole, 4).collect()}
    assert set(values) == set(close)
    for key, r in values.items():
        assert (r.avg_3, r.avg_8, r.avg_volume_4) == (close[key].avg_3, close[key].avg_8, volume[key].avg_volume_4)
    assert all(len(r["last"]) == 8 for r in state.collect())


def test_nothing_delivered_keeps_the_state(spark):
    bars = spark.createDataFrame(history(3), BARS)
    _, state = advance(spark.createDataFrame([], STATE), bars.limit(0), bars)
    state = stage(state, "state")
    values, again = advance(state, bars, bars.limit(0))
    assert values.count() == 0 and rows(again) == rows(state)


def test_a_delivery_is_dealt_and_sorted_once(spark):
    bars = spark.createDataFrame(history(4), BARS)
    even = F.pmod(F.unix_date("date"), F.lit(2)) == 0
    _, state = advance(spark.createDataFrame([], STATE), bars.limit(0), stage(bars.where(even), "bars"))
    values, after = advance(stage(state, "state"), bars.where(even), bars.where(~even))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(values) and "Window" not in plan(values) and "Window" not in plan(after)


@pytest.mark.parametrize("days", [1, 2, 7, 40, 365, 5000])
def test_high_low_against_loops(spark, days):
    rng = random.Random(days)
    data = [(s, DAY + timedelta(days=k - 300), None if rng.random() < 0.2 else rng.random(), rng.random()) for s in "AB" for k in rng.sample(range(600), 80)]
    got = {(r.symbol, r.date): (r.high_52w, r.low_52w) for r in trailing.high_low(spark.createDataFrame(data, "symbol string, date date, high double, low double"), days).collect()}
    for s, d, *_ in data:
        span = [r for r in data if r[0] == s and 0 <= (d - r[1]).days < days]
        assert got[s, d] == (max((r[2] for r in span if r[2] is not None), default=None), min(r[3] for r in span))


def test_two_sources_give_the_result_of_one(spark):
    data = [("A", DAY + timedelta(days=k), 900.0 - k, 900.0 - k, 900.0 - k, k) for k in range(400)]
    one = spark.createDataFrame(data, "symbol string, date date, high double, low double, close double, volume bigint")
    two = one.withColumn("source", F.lit("history")).unionByName(one.withColumns({"high": F.lit(1e6), "close": F.lit(0.0), "source": F.lit("bulk")}))
    for f in (trailing.trading_snapshot, trailing.high_low, trailing.moving_averages, trailing.average_volume):
        assert rows(f(two)) == rows(f(one))
    unknown = two.withColumn("source", F.when(F.col("source") == "bulk", F.lit(None)).otherwise("a"))
    assert trailing.one_bar_a_day(unknown).count() == 400


def ticks(spark, n=300):
    rng = random.Random(9)
    data = [(rng.choice("AB"), DAY + timedelta(days=rng.randint(0, 40)), rng.random(), rng.randint(1, 9), k) for k in rng.sample(range(10**6), n)]
    return data, spark.createDataFrame(data, "symbol string, date date, price double, size bigint, seq bigint")


def order():
    return order_key(F.col("seq"), F.lit(0))


def test_any_split_into_deliveries_gives_the_same_bars(spark, tmp_path):
    data, df = ticks(spark)
    whole = rows(bars_from_ticks(df, ["symbol", "date"], "price", "size", order()))
    for seed in range(2):
        rng = random.Random(seed)
        path = str(tmp_path / f"t{seed}")
        dealt = [rng.randint(0, 2) for _ in data]
        for k in [2, 0, 1, 1, 0]:
            part = spark.createDataFrame([r for r, d in zip(data, dealt) if d == k], df.schema)
            run_ticks(part, path, f"d{k}", "price", "size", order())
        assert rows(read_tick_bars(spark, path)) == whole
        cut = read_tick_bars(spark, path, start=DAY + timedelta(days=3), end=DAY + timedelta(days=9))
        assert rows(cut) == [r for r in whole if 3 <= (r[1] - DAY).days < 9]
    assert rows(read_tick_bars(spark, str(tmp_path / "none"))) == []


@pytest.mark.parametrize("unit", ["week", "month"])
def test_late_ticks_merge_into_longer_bars(spark, unit):
    data, df = ticks(spark)
    p = partial_bars(df, ["symbol", "date"], "price", "size", order())
    odd = F.pmod(F.col("open_key"), F.lit(2)) == 0
    first, second = (merge_partials(by_label(x, unit), ["symbol", "date"]) for x in (p.where(odd), p.where(~odd)))
    got = {(r.symbol, r.date): r for r in bars_of(merge_partials(first.unionByName(second), ["symbol", "date"])).collect()}
    groups = {}
    for s, d, price, size, seq in data:
        label = d - timedelta(days=d.weekday()) if unit == "week" else d.replace(day=1)
        groups.setdefault((s, label), []).append((d, seq, price, size))
    assert set(got) == set(groups)
    for key, g in groups.items():
        r = got[key]
        want = (min(g)[2], max(x[2] for x in g), min(x[2] for x in g), max(g)[2], sum(x[3] for x in g))
        assert (r.open, r.high, r.low, r.close, r.volume) == want
