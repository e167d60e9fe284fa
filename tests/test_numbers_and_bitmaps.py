"""Dense positions and member bitmaps against plain loops."""

import random

from helpers import rows

from quoteloom.functions.choices import FLAG_NAMES
from quoteloom.operators.bitmaps import BITMAP_BITS, bit_counts, bit_members, choice_bitmaps, key_bitmaps, symbol_numbers
from quoteloom.operators.numbering import dense_positions

UNIVERSE = "symbol string, indexes array<string>"


def test_positions_follow_the_order_over_many_ranges(spark):
    draw = random.Random(3)
    values = [(draw.choice([None, 7, 7, 7, draw.randrange(500)]), k, f"x{k}") for k in range(3000)]
    df = spark.createDataFrame(values, "a int, b int, pos string").repartition(7)
    got = {r["b"]: r["pos"] for r in dense_positions(df, ["a", "b"]).collect()}
    wanted = sorted(values, key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
    assert got == {v[1]: k + 1 for k, v in enumerate(wanted)}


def test_positions_of_ties_are_dense_and_of_nothing_empty(spark):
    same = spark.range(1000).selectExpr("1 AS a", "id")
    assert sorted(r[0] for r in dense_positions(same, ["a"]).select("pos").collect()) == list(range(1, 1001))
    empty = dense_positions(same.limit(0), ["a"], "n")
    assert empty.count() == 0 and empty.columns == ["a", "id", "n"]


def test_order_may_name_the_replaced_column(spark):
    df = spark.createDataFrame([("a", 30), ("b", 10), ("c", 20)], "symbol string, pos int")
    assert rows(dense_positions(df, ["pos"]).select("symbol", "pos")) == [("a", 3), ("b", 1), ("c", 2)]


def test_bitmaps_hold_the_members_of_keys_and_choices(spark):
    draw = random.Random(5)
    names = ["S&P 500", "NASDAQ 100", "NASDAQ Composite", "Russell 1000", "Other Index"]
    table = [(f"S{k:05d}", draw.sample(names, draw.randrange(len(names) + 1))) for k in range(2000)]
    df = spark.createDataFrame(table + [(None, ["S&P 500"]), ("NONE", None), table[0]], UNIVERSE)
    members = {n.translate(str.maketrans("", "", " &")): {s for s, i in table if n in i} for n in names}
    everything = {s for s, _ in table} | {"NONE"}
    numbers = symbol_numbers(df)
    keys = key_bitmaps(df, numbers)
    counts = dict(rows(bit_counts(keys, "index_key")))
    assert counts == {k: len(v) for k, v in members.items()} | {"": len(everything)}
    picked = rows(bit_members(choice_bitmaps(keys), numbers))
    wanted = {(c, s) for c, f in FLAG_NAMES.items() for s in (set().union(*(members[x] for x in f)) if f else everything)}
    assert len(picked) == len(wanted) and set(picked) == wanted


def test_bitmaps_at_the_edge_of_a_bucket(spark):
    n = BITMAP_BITS + 2
    df = spark.range(n).selectExpr("lpad(id, 6, '0') AS symbol", f"IF(id IN (0, 7, 8, {n - 3}, {n - 2}, {n - 1}), array('K'), array()) AS indexes")
    numbers = symbol_numbers(df)
    keys = key_bitmaps(df, numbers)
    assert dict(rows(bit_counts(keys, "index_key"))) == {"K": 6, "": n}
    found = bit_members(keys.where("index_key = 'K'"), numbers).select("symbol")
    assert rows(found) == [(f"{k:06d}",) for k in (0, 7, 8, n - 3, n - 2, n - 1)]


def test_a_hundred_thousand_keys(spark):
    df = spark.range(50_000).selectExpr("concat('S', id) AS symbol", "array(concat('A', id), concat('B', id), 'Every') AS indexes")
    counts = bit_counts(key_bitmaps(df, symbol_numbers(df)), "index_key")
    assert counts.count() == 100_002
    assert counts.where("members = 1").count() == 100_000
    assert counts.where("index_key = 'Every'").first()["members"] == 50_000


def test_bitmaps_of_an_empty_universe(spark):
    df = spark.createDataFrame([], UNIVERSE)
    numbers = symbol_numbers(df)
    keys = key_bitmaps(df, numbers)
    assert keys.count() == 0 and bit_members(choice_bitmaps(keys), numbers).count() == 0
