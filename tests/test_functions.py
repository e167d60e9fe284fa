from datetime import date

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quoteloom.functions import choices, dates, symbols, text


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("o"), "i").orderBy("i").select("o").collect()]


def test_clean_symbol(spark):
    got = apply(spark, ["BRK.A", " AAPL ", "X/PR", None, "NA", "", "  ", "nan", "A\tB\n"], symbols.clean_symbol)
    assert got == ["BRK-A", "AAPL", None, None, "NA", None, None, "nan", "A\tB"]


def test_clean_batch_symbol_drops_nan_text(spark):
    assert apply(spark, ["nan", "NaN", " NAN ", "NANO", "A/B", "B.C"], symbols.clean_batch_symbol) == [
        None, None, None, "NANO", None, "B-C",
    ]


def test_clean_web_symbol_drops_backslash(spark):
    assert apply(spark, ["A\\B", "A/B", "A.B"], symbols.clean_web_symbol) == [None, None, "A-B"]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="AB./\\- n", max_size=6), min_size=1, max_size=20))
def test_cleaning_twice_changes_nothing(spark, values):
    once = apply(spark, values, symbols.clean_symbol)
    assert apply(spark, once, symbols.clean_symbol) == once


def test_index_names_and_keys(spark):
    got = apply(spark, ["S&P 500, NASDAQ 100,", None, "", " , ,", "A,A"], symbols.index_names)
    assert got == [["S&P 500", "NASDAQ 100"], None, [], [], ["A"]]
    assert apply(spark, ["S&P 500", "A-B.C/D (E)"], symbols.index_key) == ["SP500", "ABCDE"]
    assert apply(spark, ["S&P MidCap 400", "NASDAQ 100", "Russell 1000"], symbols.known_index_key) == [
        "SPMidCap400", "NASDAQ100", "Russell1000",
    ]
    assert choices.KEY_TO_NAME["SP500"] == "S&P 500"


def test_exchange_name(spark):
    assert apply(spark, ["Q", "N", "P", None], symbols.exchange_name) == ["NASDAQ", "NYSE", "OTHER", "OTHER"]


def test_number_and_whole(spark):
    values = ["1.5", " 2 ", "N/A", "abc", "", None, "nan", "inf", "1.0d", "-3.99", "1e3"]
    got = apply(spark, values, text.number)
    assert got == [1.5, 2.0, None, None, None, None, None, float("inf"), None, -3.99, 1000.0]
    assert apply(spark, values, text.whole) == [1, 2, None, None, None, None, None, None, None, -3, 1000]


def test_parses_or_missing(spark):
    assert apply(spark, ["1", "N/A", None, "x", ""], text.parses_or_missing) == [True, True, True, False, True]


def test_boolean(spark):
    assert apply(spark, ["TRUE", " yes ", "1", "on", "0", "no", "", None], text.boolean) == [
        True, True, True, True, False, False, False, False,
    ]


def test_dash_list(spark):
    assert apply(spark, ["1-2-3", "7", "1-x-4", ""], text.dash_list) == [[1, 2, 3], [7], [1, 4], []]


def test_nan_becomes_null(spark):
    assert apply(spark, [1.0, float("nan"), None], text.nan_to_null, "double") == [1.0, None, None]
    assert apply(spark, [1.0, float("nan"), None], text.missing, "double") == [False, True, True]


def test_order_key_is_exact_for_all_integers(spark):
    big = 9223372036854775807
    pairs = [(0, big), (1, -big), (0, -big), (1, 0), (-1, big), (5, 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = [tuple(r) for r in df.orderBy(text.order_key(F.col("a"), F.col("b"))).collect()]
    assert got == sorted(pairs)


def test_cents(spark):
    assert apply(spark, [1.23, 0.005, -1.25, 185.58], text.cents, "double") == [123, 1, -125, 18558]


def test_file_date(spark):
    names = ["stocks_2025-10-01.csv", "x_2025-13-45.csv", "none.csv", "2025-02-28_a_2024-01-01.csv"]
    assert apply(spark, names, dates.file_date) == [date(2025, 10, 1), None, None, date(2025, 2, 28)]


def test_stored_day_does_not_move_with_the_zone(spark):
    values = ["2025-09-05 00:00:00-04:00", "2025-01-05 00:00:00-05:00", "2025-09-05", "junk", None]
    assert apply(spark, values, dates.stored_day) == [date(2025, 9, 5), date(2025, 1, 5), date(2025, 9, 5), None, None]
    assert apply(spark, values, dates.zone_suffix) == ["-04:00", "-05:00", None, None, None]


def test_with_suffix(spark):
    df = spark.createDataFrame(
        [("2025-10-01", "-04:00"), ("2025-10-01 00:00:00-04:00", "-04:00"), ("2025-10-01 00:00:00-04:00", "-05:00")],
        "d string, s string",
    )
    got = [r[0] for r in df.select(dates.with_suffix(F.col("d"), F.col("s"))).collect()]
    assert got == ["2025-10-01 00:00:00-04:00", "2025-10-01 00:00:00-04:00", "2025-10-01 00:00:00-05:00"]
    day = spark.sql("select date'2025-10-01' d").select(dates.with_suffix(F.col("d"), F.lit("-05:00")))
    assert day.first()[0] == "2025-10-01 00:00:00-05:00"


def test_resolve_range_and_period():
    today = date(2025, 10, 1)
    assert dates.resolve_range("2025-01-01", " Today ", today) == ("2025-01-01", "2025-10-01")
    assert dates.resolve_range(" nan ", "", today) == (None, None)
    assert dates.parse_period("5d") == ("d", 5)
    assert dates.parse_period("10Y") == ("y", 10)
    assert dates.parse_period("ytd") == ("ytd", 0)
    with pytest.raises(ValueError):
        dates.parse_period("5w")


def test_choices(spark):
    assert choices.parse_choice("1-2-x-3") == [1, 2, 3]
    assert choices.parse_choice(0) == [0]
    assert choices.choice_kind("1-5") == "list"
    assert choices.choice_kind("1-4") == "flags"
    assert choices.flags_for([1, 5]) == ["SP500", "NASDAQ100"]
    assert choices.flags_for([0, 1]) == []
    assert choices.lists_for([1, 0]) == ["sp500_tickers", "nasdaq100_tickers", "nasdaq_all_tickers", "iwm1000_tickers"]
    for bad in ([99], []):
        with pytest.raises(ValueError):
            choices.flags_for(bad)
    with pytest.raises(ValueError):
        choices.parse_choice("abc")
    table = choices.choice_map(spark)
    assert rows(table.filter("choice = 7 and kind = 'list'")) == [(7, "list", "etf_tickers", 0)]
    assert table.filter("kind = 'flags'").select("choice").distinct().count() == 15
