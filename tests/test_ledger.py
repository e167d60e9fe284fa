"""Backfills by a ledger of files: what they read and what they store."""

import os

from helpers import rows
from pyspark.sql import functions as F

from quoteloom.plans.bulk import run_backfill
from quoteloom.sources.files import read_csv_folder
from quoteloom.sources.history import read_bars
from quoteloom.sources.ledger import landed_files, pending, read_ledger, record

HEAD = "Symbol,Open 1 day,High 1 day,Low 1 day,Price,Volume 1 day\n"


def land(folder, name, lines, at):
    path = folder / name
    path.write_text(HEAD + "".join(f"{s},1,1,1,{p},5\n" for s, p in lines))
    os.utime(path, (at, at))
    return path


def stored(spark, store):
    return rows(read_bars(spark, store, "1d").select("symbol", F.col("date").cast("string"), "close"))


def names(df):
    return sorted(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect())


def files_read(spark, where, folder):
    """Number of files that a scan with this condition opens."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.read.text(f"{folder}/*.csv").where(where)
        plan = df._jdf.queryExecution().executedPlan()
        df._jdf.collectAsList()
        return plan.collectLeaves().apply(0).metrics().get("numFiles").get().value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_only_new_and_changed_files_are_read(spark, tmp_path):
    folder, store, ledger = tmp_path / "in [x]", str(tmp_path / "bars"), str(tmp_path / "ledger")
    folder.mkdir()
    for k in range(1, 7):
        land(folder, f"a #{k}% 2024-01-0{k}.csv", [("A", k)], 1_700_000_000 + k)
    land(folder, "no date.csv", [("Z", 1)], 1_700_000_000)
    assert rows(run_backfill(spark, str(folder), None, store, ledger_path=ledger)) == [("added", 6)]
    assert run_backfill(spark, str(folder), None, store, ledger_path=ledger) is None
    first = stored(spark, store)
    assert first == [("A", f"2024-01-0{k}", float(k)) for k in range(1, 7)]
    land(folder, "b 2024-01-03.csv", [("A", 9), ("B", 7)], 1_700_000_100)
    changed, where, only = pending(spark, landed_files(spark, str(folder)), ledger)
    assert names(changed) == ["b 2024-01-03.csv", "no date.csv"] and only is not None
    assert rows(run_backfill(spark, str(folder), None, store, ledger_path=ledger)) == [("added", 1), ("already stored", 1)]
    assert stored(spark, store) == sorted(first + [("B", "2024-01-03", 7.0)])


def test_older_files_are_left_out_before_they_are_read(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    for k in range(1, 9):
        land(folder, f"x 2024-02-0{k}.csv", [("A", k)], 1_700_000_000 + k)
    record(landed_files(spark, str(folder)), ledger)
    land(folder, "y 2024-02-01.csv", [("B", 1)], 1_700_000_050)
    land(folder, "y 2024-02-02.csv", [("B", 2)], 1_700_000_060)
    changed, where, only = pending(spark, landed_files(spark, str(folder)), ledger)
    assert only is None and names(changed) == ["y 2024-02-01.csv", "y 2024-02-02.csv"]
    assert files_read(spark, where, folder) == 2
    assert read_csv_folder(spark, str(folder), where).count() == 2


def test_changed_file_older_than_known_ones(spark, tmp_path):
    folder, ledger = tmp_path / "in", str(tmp_path / "ledger")
    folder.mkdir()
    for k in range(1, 5):
        land(folder, f"x 2024-02-0{k}.csv", [("A", k)], 1_700_000_000 + 10 * k)
    record(landed_files(spark, str(folder)), ledger)
    land(folder, "x 2024-02-02.csv", [("A", 2), ("B", 5)], 1_700_000_025)
    changed, where, only = pending(spark, landed_files(spark, str(folder)), ledger)
    assert names(changed) == ["x 2024-02-02.csv"] and only is not None
    got = read_csv_folder(spark, str(folder), where, only)
    assert names(got) == ["x 2024-02-02.csv"] * 2
    record(changed, ledger)
    assert pending(spark, landed_files(spark, str(folder)), ledger) is None
    assert read_ledger(spark, ledger).count() == 5


def test_missing_and_empty_folders(spark, tmp_path):
    store, ledger = str(tmp_path / "bars"), str(tmp_path / "ledger")
    assert run_backfill(spark, str(tmp_path / "none"), None, store, ledger_path=ledger) is None
    assert run_backfill(spark, str(tmp_path / "none"), None, store) is None
    assert read_csv_folder(spark, str(tmp_path / "none")).count() == 0
