from helpers import rows
from pyspark.sql import functions as F

from quoteloom.functions.choices import KNOWN_INDEXES, known_key
from quoteloom.operators import universe as u
from quoteloom.operators.info import info, provider_info


def raw(spark):
    return spark.createDataFrame(
        [
            ("BRK.A", "Berkshire", 900.0, "USD", "S&P 500, Russell 1000", 1),
            (" AAPL", "Apple", 3000.0, "USD", "NASDAQ 100, S&P 500, Odd-Name (X)", 2),
            ("X/PR", "Preferred", 1.0, "USD", "S&P 500", 3),
            (None, "Nothing", 1.0, "USD", "S&P 500", 4),
            ("NA", "Spelled NA", 2.0, None, "NASDAQ Composite,", 5),
            ("AAPL", "Apple again", 1.0, "USD", "Russell 2000", 6),
            ("ZZZ", "No index", None, "USD", None, 7),
        ],
        "` Symbol` string, Description string, `Market capitalization` double, "
        "`Market capitalization - Currency` string, Index string, pos bigint",
    )


def test_build_universe(spark):
    built = u.build_universe(raw(spark))
    assert built.columns == ["symbol", "description", "market_cap", "market_cap_currency", "index", "pos", "indexes"]
    assert rows(built.select("symbol", "description")) == [
        ("AAPL", "Apple"), ("BRK-A", "Berkshire"), ("NA", "Spelled NA"), ("ZZZ", "No index"),
    ]
    assert {r["symbol"]: r["indexes"] for r in built.collect()}["NA"] == ["NASDAQ Composite"]


def test_universe_without_index_column(spark):
    built = u.build_universe(raw(spark).drop("Index"))
    assert built.filter(F.size("indexes") > 0).count() == 0


def test_membership_and_counts(spark):
    members = u.membership(u.build_universe(raw(spark)))
    assert rows(u.members_per_index(members)) == [
        ("NASDAQ100", 1), ("NASDAQComposite", 1), ("OddNameX", 1), ("Russell1000", 1), ("SP500", 2),
    ]
    assert [tuple(r) for r in u.top_indexes(members, 2).collect()] == [("SP500", 2), ("NASDAQ100", 1)]


def test_dynamic_flags_agree_with_fixed_flags_on_known_names(spark):
    built = u.build_universe(raw(spark)).drop("pos")
    dynamic, fixed = u.flag_columns(built), u.known_flag_columns(built)
    shared = [known_key(n) for n in KNOWN_INDEXES if known_key(n) in dynamic.columns]
    assert sorted(shared) == ["NASDAQ100", "NASDAQComposite", "Russell1000", "SP500"]
    assert "OddNameX" in dynamic.columns
    assert rows(dynamic.select("symbol", *shared)) == rows(fixed.select("symbol", *shared))
    assert "Exchange" not in u.flag_columns(spark.createDataFrame([("A", ["S&P 500"])], "symbol string, indexes array<string>"), ["SP500"])._jdf.queryExecution().executedPlan().toString()


def test_flag_table_order(spark):
    built = u.build_universe(raw(spark).withColumn("SPX", F.lit(1)).withColumnRenamed("SPX", "spx")).drop("pos")
    built = built.withColumn("SPremium", F.lit(1))
    flags = u.flag_table(built)
    assert flags.columns[:2] == ["symbol", "description"]
    assert "SPremium" not in flags.columns and "spx" in flags.columns
    assert flags.columns[-12:] == sorted(known_key(n) for n in KNOWN_INDEXES)
    assert [r["symbol"] for r in flags.collect()] == ["AAPL", "BRK-A", "NA", "ZZZ"]


def test_choices_select_rows(spark):
    built = u.build_universe(raw(spark))
    assert rows(u.by_choice(built, 1).select("symbol")) == [("AAPL",), ("BRK-A",)]
    assert rows(u.by_choice(built, 2).select("symbol")) == [("AAPL",)]
    assert u.by_choice(built, 0).count() == 4
    assert rows(u.by_choice(built, "3-4").select("symbol")) == [("BRK-A",), ("NA",)]
    assert u.by_choice(built, "0-2").count() == 4
    assert u.by_flags(built, ["Nobody"]).count() == 0
    every = u.by_every_choice(built)
    for c in range(16):
        assert rows(every.filter(F.col("choice") == c).select("symbol")) == rows(u.by_choice(built, c).select("symbol"))


def test_flag_filter_over_stored_flags(spark):
    flagged = u.known_flag_columns(u.build_universe(raw(spark)))
    assert rows(u.flag_filter(flagged, ["SP500", "Unknown"]).select("symbol")) == [("AAPL",), ("BRK-A",)]
    assert u.flag_filter(flagged, ["Unknown"]).count() == 0
    assert u.flag_filter(flagged, []).count() == 4


def test_batch_symbols(spark):
    names = ["A", "B.C", "A", "nan", "D/E", None, "R", "NA"]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "symbol string, pos bigint")
    rejects = spark.createDataFrame([("R",)], "symbol string")
    assert rows(u.clean_batch_symbols(df, "pos", rejects)) == [("A", 0), ("B-C", 1), ("NA", 7)]
    assert u.clean_batch_symbols(df, "pos").count() == 4


def test_web_symbols_keep_rows_without_symbol(spark):
    df = spark.createDataFrame([("A.B",), ("C\\D",), (None,), ("E/F",)], "symbol string")
    assert rows(u.clean_web_symbols(df)) == [("A-B",), (None,)]


def test_union_lists_keeps_first_seen_order(spark):
    one = spark.createDataFrame([("B", 0), ("A", 1)], "symbol string, pos bigint")
    two = spark.createDataFrame([("C", 0), ("A", 1), (None, 2), ("D", 3)], "symbol string, pos bigint")
    got = u.union_lists([one, two, one]).orderBy("pos")
    assert [r["symbol"] for r in got.collect()] == ["B", "A", "C", "D"]


def test_info_projections(spark):
    built = u.build_universe(raw(spark))
    row = info(built).filter("symbol = 'NA'").first()
    assert row["description"] == "Spelled NA" and row["market_cap_currency"] is None and row["analyst_rating"] is None
    assert len(info(built).columns) == 10
    row = provider_info(built).filter("symbol = 'AAPL'").first()
    assert row["longName"] == "Apple" and row["marketCap"] == 3000.0 and row["upcoming earnings"] is None
