from datetime import date

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteloom.operators import coverage, info, merge

BAR = "symbol string, date string, close double"


def bars(spark, data):
    return spark.createDataFrame(data, BAR).withColumn("date", F.col("date").cast("date"))


def test_new_wins_and_old_wins(spark):
    old = bars(spark, [("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0)])
    new = bars(spark, [("A", "2024-01-02", 20.0), ("B", "2024-01-02", 5.0)])
    assert [r[2] for r in rows(merge.upsert_new_wins(old, new))] == [1.0, 20.0, 5.0]
    assert [r[2] for r in rows(merge.upsert_old_wins(old, new))] == [1.0, 2.0, 5.0]
    assert rows(merge.insert_only(old, new).select("symbol")) == [("B",)]


keys = st.dictionaries(st.tuples(st.sampled_from("ABC"), st.sampled_from(["2024-01-01", "2024-01-02"])), st.floats(1, 9), max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys, keys)
def test_upserts_are_idempotent_and_whole(spark, a, b):
    old = bars(spark, [(*k, v) for k, v in a.items()])
    new = bars(spark, [(*k, v) for k, v in b.items()])
    for fn, expected in ((merge.upsert_new_wins, {**a, **b}), (merge.upsert_old_wins, {**b, **a})):
        once = fn(old, new)
        assert {(r[0], str(r[1])): r[2] for r in once.collect()} == expected
        assert rows(fn(once, new)) == rows(once)


def test_add_rejects_keeps_first_date(spark):
    def rejects(*data):
        return spark.createDataFrame(data, "symbol string, d string").select("symbol", F.col("d").cast("date").alias("first_seen"))

    old, new = rejects(("A", "2024-01-05")), rejects(("A", "2024-02-01"), ("B", "2024-02-01"))
    once = merge.add_rejects(old, new)
    assert rows(once) == [("A", date(2024, 1, 5)), ("B", date(2024, 2, 1))]
    assert rows(merge.add_rejects(once, new)) == rows(once)


def test_union_wide(spark):
    a = spark.createDataFrame([("A", 1)], "symbol string, x int")
    b = spark.createDataFrame([("B", "y")], "symbol string, y string")
    assert rows(merge.union_wide([a, b])) == [("A", 1, None), ("B", None, "y")]


def test_suffix_of_last_row_is_restored(spark):
    stored = spark.createDataFrame(
        [("A", "2025-03-01 00:00:00-05:00", 1), ("A", "2025-09-05 00:00:00-04:00", 2), ("B", "2025-09-05", 1)],
        "symbol string, date_text string, pos bigint",
    )
    new = bars(spark, [("A", "2025-10-01", 1.0), ("B", "2025-10-01", 1.0), ("C", "2025-10-01", 1.0)])
    got = merge.restore_suffix(new, merge.last_suffix(stored)).select("symbol", "date_text")
    assert rows(got) == [
        ("A", "2025-10-01 00:00:00-04:00"), ("B", "2025-10-01 00:00:00-05:00"), ("C", "2025-10-01 00:00:00-05:00"),
    ]


def symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "symbol string")


def test_staleness(spark):
    stored = bars(spark, [("A", "2024-01-01", 1.0), ("A", "2024-01-05", 1.0), ("B", "2024-01-06", 1.0)])
    report = coverage.staleness(symbols(spark, "A", "B", "C"), stored, "2024-01-06")
    assert rows(report) == [("A", date(2024, 1, 5), "behind"), ("B", date(2024, 1, 6), "current"), ("C", None, "behind")]
    assert tuple(coverage.staleness_counts(report).first()) == (2, 1)


def test_counts(spark):
    stored = bars(spark, [("A", "2024-01-01", 1.0), ("A", "2024-01-05", 1.0), ("B", "2024-01-05", 1.0)])
    assert tuple(coverage.written_counts(stored).first()) == (2, 2)
    assert rows(coverage.status_counts(stored, F.when(F.col("symbol") == "A", "a").otherwise("b"))) == [("a", 2), ("b", 1)]


def test_newly_rejected_uses_daily_bars_first_and_never_rejects_all(spark):
    asked = symbols(spark, "A", "B", "C")

    def seen(*data):
        return spark.createDataFrame(list(data), "symbol string, interval string")

    daily = seen(("A", "1d"), ("B", "1wk"))
    assert rows(coverage.newly_rejected(asked, daily, "2024-01-01").select("symbol")) == [("B",), ("C",)]
    weekly = seen(("B", "1wk"))
    assert rows(coverage.newly_rejected(asked, weekly, "2024-01-01")) == [("A", date(2024, 1, 1)), ("C", date(2024, 1, 1))]
    assert coverage.newly_rejected(asked, seen(), "2024-01-01").count() == 0
    both = coverage.newly_rejected(asked, daily, "2024-01-01").select("symbol").union(daily.filter("interval = '1d'").select("symbol"))
    assert rows(both) == rows(asked)


def test_clean_and_portfolio_info(spark):
    rows_in = spark.createDataFrame([("A", "x", 1), ("A", "later", 2), ("B", "y", 3), ("C", "z", 4)], "symbol string, t string, pos int")
    delivered = symbols(spark, "A", "A", "C")
    assert rows(info.clean_info(rows_in, delivered, "pos").select("symbol", "t")) == [("A", "x"), ("C", "z")]
    got = info.portfolio_clean_info(rows_in, delivered, symbols(spark, "C", "B"))
    assert rows(got.select("symbol")) == [("C",)]


def test_attributes_on_bars(spark):
    stored = spark.createDataFrame([("A", 5), ("B", 6)], "symbol string, volume int")
    attributes = spark.createDataFrame([("A", 9, "Tech", "other")], "symbol string, volume int, sector string, nope string")
    got = info.with_attributes(stored, attributes)
    assert got.columns == ["symbol", "volume", "snapshot_volume", "sector"]
    assert rows(got) == [("A", 5, 9, "Tech"), ("B", 6, None, None)]


def test_attributes_from_json(spark):
    landed = spark.createDataFrame(
        [("A", '{"sector": "Tech", "marketCap": 12.5, "trailingPE": "N/A", "currency": "EUR"}'), ("B", "{}"), ("C", "broken")],
        "symbol string, json string",
    )
    attributes = info.attributes_from_json(landed)
    assert len(attributes.columns) == 59
    assert rows(attributes.select("symbol", "sector", "marketCap", "trailingPE")) == [
        ("A", "Tech", 12.5, None), ("B", None, None, None), ("C", None, None, None),
    ]
    shown = {r["symbol"]: r["market_cap_currency"] for r in info.info_from_attributes(attributes).collect()}
    assert shown == {"A": "EUR", "B": "USD", "C": "USD"}
