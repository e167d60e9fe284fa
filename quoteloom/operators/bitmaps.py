"""A1, A6, P11, P12 as bitmaps: members of any number of index keys, choices as bit operations.

Symbols are numbered once (``symbol_numbers``). The members of a key are bitmaps of 4 KB, one for each 32,768 numbers
that hold a member, and Spark merges them map-side: a key that a third of all symbols share shuffles a few KB per task.
Keys are rows, so no list of them passes through the driver, however many there are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.functions.choices import FLAG_NAMES
from quoteloom.operators.numbering import dense_positions
from quoteloom.operators.universe import membership
from quoteloom.session import stage

# Numbers in one bitmap.
BITMAP_BITS = 32768
# Key of the bitmaps of all symbols; index keys are never empty.
EVERYTHING = ""


def symbol_numbers(universe: DataFrame) -> DataFrame:
    """The dictionary: each symbol once, with its ``number`` from 1 in symbol order. Stored, so that it can be read often."""
    symbols = universe.select("symbol").where(F.col("symbol").isNotNull()).distinct()
    return stage(dense_positions(symbols, ["symbol"], "number"), "symbol-numbers")


def key_bitmaps(universe: DataFrame, numbers: DataFrame) -> DataFrame:
    """``(index_key, bucket, bits)``: the members of each key, and of :data:`EVERYTHING`."""
    known = membership(universe).join(numbers, "symbol").select("index_key", "number")
    rows = known.unionByName(numbers.select(F.lit(EVERYTHING).alias("index_key"), "number"))
    bucket = F.bitmap_bucket_number("number").alias("bucket")
    return rows.groupBy("index_key", bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def choice_bitmaps(keys: DataFrame, flags: Mapping[int, Sequence[str]] = FLAG_NAMES) -> DataFrame:
    """``(choice, bucket, bits)``: the union of each choice's keys; a choice without keys means all symbols."""
    wanted = [F.when(F.col("index_key").isin(*(names or [EVERYTHING])), F.lit(c)) for c, names in flags.items()]
    each = keys.select(F.explode(F.array_compact(F.array(*wanted))).alias("choice"), "bucket", "bits")
    return each.groupBy("choice", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_counts(bitmaps: DataFrame, by: str) -> DataFrame:
    """Number of members for each value of ``by``."""
    return bitmaps.groupBy(by).agg(F.sum(F.bitmap_count("bits")).alias("members"))


def bit_members(bitmaps: DataFrame, numbers: DataFrame) -> DataFrame:
    """The bitmaps with one row per member, its ``symbol`` in place of the bits."""
    others = [c for c in bitmaps.columns if c not in ("bucket", "bits")]
    # At most 4096 bytes a row, of which only those with a member go on.
    byte = lambda k: F.substring(F.col("bits"), k + 1, F.lit(1))
    at = F.filter(F.sequence(F.lit(0), F.length("bits") - 1), lambda k: byte(k) != F.lit(b"\x00"))
    each = bitmaps.select(*others, "bucket", "bits", F.explode(at).alias("_at"))
    each = each.withColumn("_byte", F.conv(F.hex(byte(F.col("_at"))), 16, 10).cast("int"))
    bits = F.filter(F.sequence(F.lit(0), F.lit(7)), lambda b: F.getbit("_byte", b) == 1)
    each = each.select(*others, "bucket", "_at", F.explode(bits).alias("_bit"))
    number = (F.col("bucket") - 1) * BITMAP_BITS + F.col("_at") * 8 + F.col("_bit") + 1
    return each.select(*others, number.alias("number")).join(numbers, "number").select(*others, "symbol")
