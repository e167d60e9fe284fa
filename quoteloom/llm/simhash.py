"""Near-duplicate groups by SimHash fingerprints, found with the generalised pigeonhole principle.

Fingerprints are made inside the tasks that read the texts; only distinct fingerprints go on, so any number of
exact copies is one row. The 64 bits are dealt into ``m`` parts, correlated bits together. Two fingerprints at
distance ``radius`` or less differ by at most ``t_i`` bits in some part ``i`` whenever the ``t_i`` add up to
``radius - m + 1`` (a part with ``t_i = -1`` is not looked at). The parts and thresholds come from counts over all
fingerprints: pairs that agree in a part are counted, pairs at one more differing bit are estimated from how often
two fingerprints agree in each bit, and dynamic programming picks the thresholds with the least estimated work.
A probe looks up all values within ``t_i`` bits of its own; the join condition checks the whole distance, so only
real links leave the join. Distinct fingerprints within 3 bits of each other number 128 at most, so groups of
copies do not make links by the square of their size.

Defined results: texts without a word have fingerprint zero and are linked like any other; a NULL text has no
words; a row without an id gets its fingerprint, and the component of the rows it is linked to (NULL if none of
them has an id); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import small_batches
from quoteloom.llm.components import connected_components
from quoteloom.session import stage

BITS, SEED = 64, 42
# Estimated work of checking one candidate pair, counted in rows that are shuffled to find it.
PAIR_WORK = 12


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash over the hashes of all word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = np.concatenate([[0], ends[:-shingle] + 1]).tolist()
        hashes = [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]
    seen = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = seen.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["id", "fp"])

    small_batches(df)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, fp long")


def _co_occurrence(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and in how many of them both bits i and j are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), dtype=np.int64), 0
        for batch in batches:
            raw = np.ascontiguousarray(batch.column(0).to_numpy()).astype("<i8").view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        places = np.concatenate([[-1], np.arange(BITS * BITS)])
        counts = np.concatenate([[n], total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(places.astype(np.int32)), pa.array(counts)], ["place", "n"])

    sums = prints.select("fp").mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n")).collect()
    found = dict(sums)
    return found.get(-1, 0), np.array([found.get(k, 0) for k in range(BITS * BITS)]).reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into parts of nearly equal width; each part starts from a free bit and takes those most correlated."""
    p = both.diagonal() / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    strength = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread)
    free, out = set(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        rest = sorted(free)
        part = [max(rest, key=lambda b: (strength[b, rest].sum(), -b))]
        while len(part) < width:
            part.append(max((b for b in rest if b not in part), key=lambda b: (strength[b, part].sum(), -b)))
        free -= set(part)
        out.append(sorted(part))
    return out


def ball(width: int, radius: int) -> int:
    return sum(comb(width, k) for k in range(radius + 1))


def allocate(work: list[dict[int, float]], total: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds that add up to ``total`` with the least summed work; ``work[i][t]`` is that of part i at t."""
    best = {0: (0.0, ())}
    for options in work:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for used, (cost, chosen) in best.items():
            for t, w in options.items():
                if used + t not in step or step[used + t][0] > cost + w:
                    step[used + t] = (cost + w, (*chosen, t))
        best = step
    return best[total]


def _mask(bits: list[int] | tuple[int, ...]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def plan_probes(prints: DataFrame, radius: int) -> list[tuple[list[int], int]]:
    """(bits of a part, its threshold) for the division into parts with the least estimated work."""
    n, both = _co_occurrence(prints)
    p = both.diagonal() / max(n, 1)
    differ = 2 * p * (1 - p)
    odds = differ / np.maximum(1 - differ, 1e-9)
    layouts = {m: group_bits(n, both, m) for m in range(2, radius + 2)} if radius else {1: [list(range(BITS))]}
    keys = [
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_mask(bits))).alias("v"))
        for m, parts in layouts.items()
        for i, bits in enumerate(parts)
    ]
    values = prints.select(F.explode(F.array(*keys)).alias("k")).groupBy("k.m", "k.i", "k.v").agg(F.count("*").alias("c"))
    pairs = values.groupBy("m", "i").agg(F.sum(F.expr("c * (c - 1) / 2")).alias("pairs"))
    agreeing = {(m, i): float(x) for m, i, x in pairs.collect()}
    plans = []
    for m, parts in layouts.items():
        work = []
        for i, bits in enumerate(parts):
            options = {-1: 0.0}
            near = [1.0]  # sums of products of the bits' odds: pairs at k differing bits for one that agrees
            for b in bits:
                near = [x + (near[k - 1] * odds[b] if k else 0) for k, x in enumerate([*near, 0.0])][: radius + 1]
            for t in range(radius - m + 2 + (m - 1)):
                if t > radius or t >= len(near):
                    break
                found = max(agreeing.get((m, i), 0.0), n * n / 2 / 2.0 ** len(bits)) * sum(near[: t + 1])
                options[t] = n * (1 + ball(len(bits), t)) + PAIR_WORK * found
            work.append(options)
        plans.append((*allocate(work, radius - m + 1), m))
    _, thresholds, m = min(plans)
    return [(bits, t) for bits, t in zip(layouts[m], thresholds) if t >= 0]


def links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs ``(u, v)``, ``u < v``, of distinct fingerprints (column ``fp``) that differ in ``radius`` bits or fewer."""
    probes, index = [], []
    for i, (bits, threshold) in enumerate(plan_probes(prints, radius)):
        mask = F.lit(_mask(bits))
        index.append(F.struct(F.lit(i).alias("part"), mask.alias("mask")))
        for k in range(threshold + 1):
            flips = [F.lit(_mask(c)) for c in combinations(bits, k)]
            probes += [F.struct(F.lit(i).alias("part"), mask.alias("mask"), f.alias("flip")) for f in flips]
    key: Column = F.col("fp").bitwiseAND(F.col("x.mask"))
    left = prints.select("fp", F.explode(F.array(*probes)).alias("x"))
    left = left.select("x.part", key.bitwiseXOR(F.col("x.flip")).alias("key"), F.col("fp").alias("u"))
    right = prints.select("fp", F.explode(F.array(*index)).alias("x"))
    right = right.select("x.part", key.alias("key"), F.col("fp").alias("v"))
    near = (F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)
    return left.join(right, ["part", "key"]).where(near).select("u", "v").distinct()


def simhash_groups(
    df: DataFrame, radius: int = 3, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, fp, component)`` of every row; the component is the smallest id that links lead to."""
    prints = stage(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "distinct-fingerprints")
    groups = connected_components(links(distinct, radius))
    linked = distinct.join(groups, F.col("fp") == F.col("node"))
    roots = linked.groupBy("component").agg(F.min("least_id").alias("root_id"))
    linked = linked.join(stage(roots, "roots"), "component").select("fp", "root_id")
    labels = distinct.join(linked, "fp", "left").select("fp", F.coalesce("root_id", "least_id").alias("component"))
    return prints.join(stage(labels, "labels"), "fp").select("id", "fp", "component")
