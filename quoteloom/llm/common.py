"""Small helpers of the text operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters held at once while texts are worked on as arrays; one longer text is worked on alone.
CHUNK_CHARS = 1_000_000
# Rows that go to a Python worker at once: a few MB of texts, in the worker and in the JVM beside it.
BATCH_ROWS = 1000


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> None:
    """Makes the session hand at most :data:`BATCH_ROWS` rows to Python workers at once."""
    name, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, BATCH_ROWS)


def fold(doc_id: str = "doc_id") -> Column:
    """Fold 0 to 4 of a row: ``crc32`` of the id as text, modulo 5; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string")) % 5


def chunks(texts: Sequence[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges ``(first, end)`` over all texts, each with about ``limit`` characters or a single text."""
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > limit:
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def segment_ids(counts: np.ndarray) -> np.ndarray:
    """``[2, 0, 1]`` to ``[0, 0, 2]``: the number of the segment that each element belongs to."""
    return np.repeat(np.arange(len(counts)), counts)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores in front until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Position of each unsigned hash in a filter of so many bits, a power of two: its upper bits."""
    return (hashes >> np.uint64(65 - bits.bit_length())).astype(np.int64)


def has_places(bitmap: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the filter has each position."""
    return ((bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def bit_filter(hashes: DataFrame, bits: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Filter of the 64-bit hashes in column ``h``, packed: positions ``lo`` to ``hi`` of ``bits``."""
    hi = bits if hi is None else hi
    place = F.shiftrightunsigned("h", 65 - bits.bit_length())
    marked = hashes.select(place.alias("p")).where((F.col("p") >= lo) & (F.col("p") < hi)).select((F.col("p") - lo + 1).alias("p"))
    parts = marked.groupBy(F.bitmap_bucket_number("p").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    whole = np.zeros((hi - lo) // 8, dtype=np.uint8)
    for part, data in parts.collect():  # (hi - lo) / 8 bytes in all
        start = (part - 1) * 4096
        found = np.frombuffer(bytes(data), np.uint8)
        whole[start : start + 4096] = found[: len(whole) - start]
    return whole
