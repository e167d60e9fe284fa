"""The store by symbol against dictionaries, and what a merge touches."""

import os
import random

import pytest
from helpers import rows

from quoteloom.sinks import symbol_store
from quoteloom.sinks.symbol_store import bucket_of, merge_store, read_manifest, read_store

SMALL = "symbol string, date string, close double"


def bars(spark, data):
    return spark.createDataFrame([(s, d, c) for (s, d), c in data.items()], SMALL)


def files(path):
    return {os.path.join(at, f) for at, _, names in os.walk(f"{path}/data") for f in names if f.endswith(".parquet")}


def stored(spark, path):
    return {(r["symbol"], r["date"]): r["close"] for r in read_store(spark, path, schema=SMALL).collect()}


def merge(spark, path, data, **kw):
    return merge_store(spark, bars(spark, data), path, 16, schema=SMALL, **kw)


@pytest.mark.parametrize("new_wins", [True, False])
def test_deliveries_in_turn_equal_a_dictionary(spark, tmp_path, new_wins):
    draw, path, wanted = random.Random(1), str(tmp_path), {}
    for n in (400, 60, 0, 5, 200):
        data = {(f"S{draw.randrange(90)}", f"2024-01-{draw.randrange(1, 29):02d}"): float(draw.randrange(1000)) for _ in range(n)}
        merge(spark, path, data, new_wins=new_wins)
        wanted = wanted | data if new_wins else data | wanted
        assert stored(spark, path) == wanted
    some = ["S1", "S7", "never"]
    got = read_store(spark, path, some, SMALL)
    assert {r["symbol"] for r in got.collect()} == {s for s, _ in wanted} & set(some)
    assert got.count() == sum(s in some for s, _ in wanted)


def test_only_buckets_of_delivered_symbols_are_written(spark, tmp_path):
    path = str(tmp_path)
    everything = {(f"S{k:04d}", "2024-01-01"): float(k) for k in range(2000)}
    merge(spark, path, everything)
    before = files(path)
    one = {("S0007", "2024-01-02"): 1.0, ("S0007", "2024-01-03"): 2.0}
    (bucket,) = spark.range(1).select(bucket_of(symbol_store.F.lit("S0007"), 16)).first()
    assert merge(spark, path, one) == [bucket]
    fresh = files(path) - before
    assert fresh and all(f"/version=2/bucket={bucket}/" in f for f in fresh)
    assert before <= files(path)  # the manifest before still names them
    assert stored(spark, path) == everything | one
    merge(spark, path, {("S0007", "2024-01-04"): 3.0})
    assert not any(f"/version=1/bucket={bucket}/" in f for f in files(path))
    assert {r["version"] for r in read_manifest(spark, path).collect()} == {1, 3}


def test_failure_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path, first = str(tmp_path), {("A", "2024-01-01"): 1.0, ("B", "2024-01-01"): 2.0}
    merge(spark, path, first)

    def fail(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(symbol_store, "switch", fail)
        with pytest.raises(RuntimeError):
            merge(spark, path, {("A", "2024-01-01"): 9.0, ("C", "2024-01-01"): 3.0})
    assert stored(spark, path) == first
    merge(spark, path, {("A", "2024-01-01"): 5.0})
    assert stored(spark, path) == first | {("A", "2024-01-01"): 5.0}


def test_missing_store_and_bars_without_key(spark, tmp_path):
    path = str(tmp_path)
    assert rows(read_store(spark, path, schema=SMALL)) == [] and rows(read_store(spark, path, ["A"], SMALL)) == []
    assert merge(spark, path, {(None, "2024-01-01"): 1.0}) == []
    merge(spark, path, {(None, "2024-01-01"): 1.0, ("A", None): 2.0, ("A", "2024-01-01"): 3.0})
    assert rows(read_store(spark, path, schema=SMALL)) == [("A", "2024-01-01", 3.0)]


def shuffled_records(spark):
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(*[getattr(store, f"stageList$default${k}")() if k > 1 else None for k in range(1, 6)])
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


@pytest.mark.parametrize("new_wins", [True, False])
def test_bars_of_other_dates_are_copied_without_a_shuffle(spark, tmp_path, new_wins):
    path = str(tmp_path)
    wanted = {(f"S{s}", f"20{y}-{m:02d}-01"): float(s) for s in range(20) for y in range(10, 20) for m in range(1, 13)}
    merge_store(spark, bars(spark, wanted), path, 1, schema=SMALL)
    for k in range(2):  # inside the stored dates, then all newer
        data = {("S1", "2012-05-01"): -1.0, ("S1", "2012-05-02"): -2.0} if k == 0 else {("S2", "2030-01-01"): 1.0}
        before = shuffled_records(spark)
        merge(spark, path, data, new_wins=new_wins)
        assert shuffled_records(spark) - before < 300  # of 2400 stored bars
        wanted = wanted | data if new_wins else data | wanted
        assert stored(spark, path) == wanted


def test_files_of_a_bucket_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(symbol_store, "MANY_FILES", 4)
    path, wanted = str(tmp_path), {}
    for k in range(8):
        data = {(f"S{s}", f"2024-01-{k + 1:02d}"): float(k) for s in range(30)}
        merge_store(spark, bars(spark, data), path, 1, schema=SMALL)
        wanted |= data
    assert stored(spark, path) == wanted
    versions = {r["version"] for r in read_manifest(spark, path).collect()}
    assert len([f for f in files(path) if f"/version={max(versions)}/" in f]) < 4 + symbol_store.SLICES
