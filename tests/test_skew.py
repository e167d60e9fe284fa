"""One symbol with a third of all rows: same results as brute force, and a plan that spreads it."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quoteloom.functions.text import order_key
from quoteloom.operators.bars import bars_from_ticks
from quoteloom.operators.coverage import staleness
from quoteloom.operators.dedup import keep_last
from quoteloom.operators.info import with_attributes
from quoteloom.operators.universe import exclude, restrict

N = 120_000


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "ticks")
    spark.range(N, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 400).cast("string")).alias("symbol"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.hash("id") % 50).cast("int")).alias("date"),
        F.col("id").alias("seq"),
        ((F.col("id") * 7919) % 1000 / F.lit(8.0)).alias("price"),
        (F.col("id") % 100).alias("size"),
        F.repeat(F.lit("x"), 50).alias("payload"),
    ).write.parquet(path)
    return spark.read.parquet(path)


SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bars_of_a_hot_symbol(hot):
    got = bars_from_ticks(hot, ["symbol", "date"], "price", "size", order_key(F.unix_date("date"), F.col("seq"))).toPandas()
    ticks = hot.toPandas().sort_values("seq")
    want = ticks.groupby(["symbol", "date"]).agg(
        open=("price", "first"), high=("price", "max"), low=("price", "min"), close=("price", "last"), volume=("size", "sum")
    ).reset_index()
    keys = ["symbol", "date"]
    pd.testing.assert_frame_equal(
        got.sort_values(keys).reset_index(drop=True), want[got.columns].sort_values(keys).reset_index(drop=True), check_dtype=False
    )


def test_last_row_per_key_of_a_hot_symbol(hot):
    got = keep_last(hot.select("symbol", "seq", "payload"), ["symbol"], "seq").select("symbol", "seq").toPandas()
    want = hot.groupBy("symbol").agg(F.max("seq").alias("seq")).toPandas()
    assert sorted(map(tuple, got.values)) == sorted(map(tuple, want.values))


def _known(spark):
    return spark.range(400).select(F.col("id").cast("string").alias("symbol")).union(spark.sql("SELECT 'HOT'")).withColumn("sector", F.lit("s"))


@pytest.mark.parametrize(
    "join, count",
    [
        (lambda hot, known: with_attributes(hot, known), N),
        (lambda hot, known: restrict(hot, known), N),
        (lambda hot, known: exclude(hot, known.filter("symbol <> 'HOT'")), N // 3),
    ],
    ids=["attributes", "restrict", "exclude"],
)
def test_joins_split_the_hot_symbol(spark, hot, no_broadcast, join, count):
    df = join(hot, _known(spark))
    assert len(df.collect()) == count
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_staleness_groups_before_it_joins(spark, hot, no_broadcast):
    report = staleness(_known(spark), hot, "2024-02-19")
    assert report.count() == 401
    assert report.filter("symbol = 'HOT'").first()["status"] == "current"
