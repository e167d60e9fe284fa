"""Removal of lines that stand in several documents, kept where the smallest id holds them.

Two Bloom filters over 64-bit line hashes say which lines were seen once and which twice. Every task turns its
lines into the filter positions they set (a few bytes a line); the positions meet by filter part, where a position
set once belongs to the first filter and one set again to the second. Only the second filter goes on: lines it
holds are suspected repeats, and only those shuffle. Grouping them by their whole key confirms real repeats and
picks the first document. Documents without a suspected line pass through without a shuffle.

The filter takes 16 bits for each line, rounded up to a power of two, and never more than ``MAX_FILTER_BITS``
(128 MB, the size that tasks get). Above 67 million lines it gets denser: more lines are suspected and shuffled,
and the result stays the same.

Defined results: a NULL text has no lines and stays NULL; a row without an id keeps its lines and takes no part in
the comparison; rows that repeat an id are one document; a document may lose all lines and then has an empty text;
an empty table gives no rows. Other columns pass through whatever their names are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quoteloom.llm.common import fresh, mixed, small_batches
from quoteloom.session import stage

MIN_FILTER_BITS, MAX_FILTER_BITS, BITS_PER_LINE = 1 << 20, 1 << 30, 16
PARTS = 256
# Line hashes that a task holds before it hands their positions on.
HELD_HASHES = 1 << 20


def line_keys(text: str) -> list[bytes]:
    """Key of every line: ASCII blanks off both ends, A-Z in lower case."""
    return [line.strip() for line in text.encode().lower().split(b"\n")]


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or key.isascii() or len(key.decode()) >= least)


def _distinct(text: str, least: int) -> dict[bytes, int]:
    """The keys that count, in order of appearance, with their number."""
    keys = dict.fromkeys(line_keys(text))
    return {key: slot for slot, key in enumerate(k for k in keys if _long(k, least))}


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two filter positions of each hash."""
    mask = np.uint64(bits - 1)
    return np.stack([hashes & mask, mixed(hashes) & mask], axis=1).astype(np.int64)


def _filter_size(docs: DataFrame, text_col: str) -> int:
    breaks = F.length(text_col) - F.length(F.replace(F.col(text_col), F.lit("\n"), F.lit(""))) + 1
    lines = docs.agg(F.sum(breaks.cast("long"))).first()[0] or 0
    return max(MIN_FILTER_BITS, min(MAX_FILTER_BITS, 1 << max(0, BITS_PER_LINE * lines - 1).bit_length()))


def twice_filter(docs: DataFrame, text_col: str, least: int, bits: int) -> np.ndarray:
    """The second filter as packed bits: positions that line hashes set at least twice."""
    part_bits = bits // PARTS

    def set_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            places = np.sort(np.repeat(_positions(hashes, bits), np.minimum(counts, 2), axis=0).ravel())
            parts, starts = np.unique(places // part_bits, return_index=True)
            inside = (places % part_bits).astype("<u4")
            data = [x.tobytes() for x in np.split(inside, starts[1:])]
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(data, pa.binary())], ["part", "places"])

        held, n = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                keys = _distinct(text, least)
                held.append(np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64))
                n += len(keys)
                if n >= HELD_HASHES:
                    yield out(held)
                    held, n = [], 0
        if n:
            yield out(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(part: int, seen: np.ndarray) -> pa.RecordBatch:
            packed = np.packbits(seen >= 2, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed], pa.binary())], ["part", "twice"])

        at, seen = None, None
        for batch in batches:
            for part, data in zip(*(c.to_pylist() for c in batch.columns)):
                if part != at:
                    if seen is not None:
                        yield out(at, seen)
                    at, seen = part, np.zeros(part_bits, dtype=np.uint8)
                places, counts = np.unique(np.frombuffer(data, "<u4"), return_counts=True)
                seen[places] = np.minimum(seen[places] + np.minimum(counts, 2), 2)
        if seen is not None:
            yield out(at, seen)

    partial = docs.where(F.col(text_col).isNotNull()).select(text_col).mapInArrow(set_positions, "part int, places binary")
    merged = partial.repartition("part").sortWithinPartitions("part").mapInArrow(merge, "part int, twice binary")
    whole = np.zeros(bits // 8, dtype=np.uint8)
    for part, twice in merged.collect():  # at most MAX_FILTER_BITS / 8 bytes
        whole[part * part_bits // 8 : (part + 1) * part_bits // 8] = np.frombuffer(twice, np.uint8)
    return whole


def _suspected(keys: dict[bytes, int], twice: np.ndarray) -> list[tuple[bytes, int, int]]:
    """(key, number, hash) of the keys that the second filter holds."""
    hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
    if not len(hashes):
        return []
    places = _positions(hashes, len(twice) * 8)
    hit = ((twice[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)
    signed = hashes.view(np.int64).tolist()
    return [(k, s, signed[s]) for (k, s), h in zip(keys.items(), hit.tolist()) if h]


def dedup_lines(
    docs: DataFrame,
    min_chars: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """``docs`` with the repeated lines taken out of the text column.

    A line repeats if its key (see :func:`line_keys`) has at least ``min_chars`` code points and stands in two
    documents or more. ``counts`` names two more columns: lines before, and lines taken out.
    """
    small_batches(docs)
    spark = docs.sparkSession
    bits = _filter_size(docs, text_col)
    twice = spark.sparkContext.broadcast(twice_filter(docs, text_col, min_chars, bits))
    drop_id, drops = fresh(docs, "drop_id", "drops")
    names = list(docs.columns)
    text_at, id_at = names.index(text_col), names.index(id_col)
    out_schema = StructType(list(docs.schema) + [StructField(c, LongType()) for c in counts or ()])

    def is_suspect(text, doc_id) -> bool:
        return text is not None and doc_id is not None and bool(_suspected(_distinct(text, min_chars), twice.value))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc_id, slot, h, key.decode())
                for doc_id, text in zip(*(c.to_pylist() for c in batch.columns))
                for key, slot, h in _suspected(_distinct(text, min_chars), twice.value)
            ]
            columns = zip(*rows) if rows else [[]] * 4
            kinds = (batch.schema.field(0).type, pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["id", "slot", "hash", "key"])

    def select(batches: Iterator[pa.RecordBatch], suspects: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(text_at).to_pylist(), batch.column(id_at).to_pylist())
            yield batch.filter(pa.array([is_suspect(t, i) == suspects for t, i in pairs], pa.bool_()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has_drops = len(batch.schema) > len(names)
            texts, n_lines, n_dropped = [], [], []
            lists = batch.column(len(names)).to_pylist() if has_drops else [None] * batch.num_rows
            for text, gone in zip(batch.column(text_at).to_pylist(), lists):
                if text is None or not gone:
                    texts.append(text)
                    n_lines.append(1 if text is None else text.count("\n") + 1)
                    n_dropped.append(0)
                    continue
                gone = {(d["slot"], d["hash"]) for d in gone}
                dropped = {k for k, s, h in _suspected(_distinct(text, min_chars), twice.value) if (s, h) in gone}
                lines = text.split("\n")
                kept = [line for line, key in zip(lines, line_keys(text)) if key not in dropped]
                texts.append("\n".join(kept))
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            columns = [c for c in batch.columns[: len(names)]]
            columns[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            fields = [batch.schema.field(k) for k in range(len(names))]
            for name, values in zip(counts or (), (n_lines, n_dropped)):
                columns.append(pa.array(values, pa.int64()))
                fields.append(pa.field(name, pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    id_type = docs.schema[id_col].dataType.simpleString()
    known = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    suspects = stage(
        known.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            find, f"id {id_type}, slot int, hash long, key string"
        ),
        "suspected-lines",
    )
    ends = suspects.groupBy("key").agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
    repeats = stage(ends.where("first_id < last_id").select("key", "first_id"), "repeated-lines")
    gone = (
        suspects.join(repeats, "key")
        .where("id > first_id")
        .groupBy(F.col("id").alias(drop_id))
        .agg(F.collect_set(F.struct("slot", "hash")).alias(drops))
    )
    whole = docs.mapInArrow(lambda batches: cut(select(batches, False)), out_schema)
    touched = docs.mapInArrow(lambda batches: select(batches, True), docs.schema)
    touched = touched.join(gone, F.col(id_col) == F.col(drop_id), "left").select(*[F.col(f"`{c}`") for c in names], drops)
    return whole.unionByName(touched.mapInArrow(cut, out_schema))
