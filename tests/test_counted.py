"""Counts observed on a write, and sketches by date, against sets."""

import random
from datetime import date, timedelta

from helpers import rows
from pyspark.sql import functions as F

from quoteloom.sinks.counted import SKETCHES, bound, counts_between, keep_sketches, replace_dates_counted
from quoteloom.sinks.tables import as_bars
from quoteloom.sources.files import read_table
from quoteloom.sources.history import read_bars

DAY = date(2024, 1, 1)


def bars(spark, data):
    df = spark.createDataFrame([(s, DAY + timedelta(d), c) for s, d, c in data], "symbol string, date date, close double")
    return as_bars(df, "1d", "batch")


def near(found, exact):
    return abs(found - exact) <= bound() * exact


def test_counts_of_a_write(spark, tmp_path):
    draw, path = random.Random(2), str(tmp_path / "bars")
    data = [(f"S{k}", d, float(draw.randrange(100))) for k in range(3000) for d in draw.sample(range(20), 2)]
    up = F.col("close") > 50
    got = replace_dates_counted(bars(spark, data), path, {"up": up, "down": ~up})
    wanted_up = sum(c > 50 for _, _, c in data)
    assert (got["rows"], got["dates"], got["up"], got["down"]) == (6000, 20, wanted_up, 6000 - wanted_up)
    assert near(got["symbols"], 3000)
    assert read_bars(spark, path, "1d").count() == 6000
    nothing = replace_dates_counted(bars(spark, data).limit(0), path, {"up": up})
    assert nothing == {"rows": 0, "dates": 0, "symbols": 0, "up": 0}
    assert read_bars(spark, path, "1d").count() == 6000


def test_sketches_follow_replaced_and_added_dates(spark, tmp_path):
    path, days = str(tmp_path / "sketches"), {}
    steps = [(range(0, 10), 500, False), (range(5, 12), 80, False), (range(11, 14), 2000, True)]
    for n, (span, size, added) in enumerate(steps):
        data = [(f"S{n}-{k % 1500}" if added else f"S{k}", d, 1.0) for d in span for k in range(size)]
        keep_sketches(spark, bars(spark, data), path, added)
        for d in span:
            here = [s for s, at, _ in data if at == d]
            days[d] = days.get(d, []) + here if added else here
    sketches = read_table(spark, path, SKETCHES)
    for start, end in ((0, 14), (3, 7), (11, 12), (13, 40), (30, 40)):
        (got,) = rows(counts_between(sketches, DAY + timedelta(start), DAY + timedelta(end)))
        inside = {d: s for d, s in days.items() if start <= d < end}
        exact = len(set().union(*inside.values()))
        assert got[:2] == (sum(map(len, inside.values())), len(inside)) and near(got[2], exact)
    by_day = counts_between(sketches, by=F.col("date")).collect()
    assert all(near(r["symbols"], len(set(days[(r["date"] - DAY).days]))) for r in by_day) and len(by_day) == 14
