"""Exact ranked search by inner product over sparse ball trees.

The score of a document for a query is an inner product: the query's term counts with the document's impacts, which
are whole numbers (weight of a term times its saturated frequency). Only terms of the queries can count, so a scan of
the texts leaves one small vector a document, written once; document frequencies are counted from these vectors.

Each task builds ball trees over blocks of vectors. A node has a centroid ``c`` and a radius ``r``; no vector below it
has a larger product with query ``q`` than ``q.c + |q'| r``, where ``q'`` has those terms of ``q`` that occur below the
node (elsewhere vectors and centroid are all zero). Nodes are opened best bound first; once the best bound left
is less than the k-th best score so far, the rest of the tree is pruned. Leaves are scored in exact integers. Bounds
are rounded up by more than floating-point sums can err, and a bound that equals the k-th best score is followed, so
ties are met as well. The best scores go on from block to block of a task; tasks hand on k rows a query, whose best k
are found in two steps.

Queries are taken in blocks of at most ``QUERIES`` rows and ``VOCABULARY`` different terms (or one row alone); the
vocabulary of one block is all that is sent to tasks. Each block is a scan of its own.

Defined results: a NULL text has no terms; documents without terms count for nothing; documents without an id count
for the statistics and are not ranked; rows that repeat an id are documents of their own; repeated query rows are one
query, a query id with several texts is ranked for each; a query without a known term gives no rows; empty tables give
none; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from bisect import insort
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quoteloom.llm.common import small_batches
from quoteloom.session import stage

QUERIES, VOCABULARY = 500, 20_000
# Vectors and entries of a tree, and vectors of a leaf.
BLOCK, BLOCK_ENTRIES, LEAF = 8192, 4_000_000, 16
SALTS = 64
# Relative slack of bounds; sums of a million products err by less.
SLACK = 1e-9
_TERMS = bytes(k + 32 if 65 <= k <= 90 else k if 48 <= k <= 57 or 97 <= k <= 122 or k >= 128 else 32 for k in range(256))


def terms(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode().translate(_TERMS).split()


def query_blocks(queries: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """Blocks of ``(id, Counter of terms)``; only one block is held at a time."""
    block, known = [], set()
    rows = queries.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).distinct()
    for row in rows.toLocalIterator():
        counts = Counter(terms(row.text))
        if not counts:
            continue
        if block and (len(block) >= QUERIES or len(known.union(counts)) > VOCABULARY):
            yield block
            block, known = [], set()
        block.append((row.id, counts))
        known.update(counts)
    if block:
        yield block


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(id, n, term, tf)`` of documents with terms: their number, and number and frequency of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            keep, sizes, found, counts = [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                words = terms(text)
                if not words:
                    continue
                seen = Counter(map(known.get, words))
                seen.pop(None, None)
                keep.append(k)
                sizes.append(len(words))
                found.append(list(seen.keys()))
                counts.append(list(seen.values()))
            lists = [pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), *lists], ["id", "n", "term", "tf"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n long, term array<int>, tf array<int>")


def _flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of all entries of the rows that begin at ``starts``."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class BallTree:
    """Over rows of ``values`` (whole numbers) at ``columns``, row k from ``starts[k]`` on; no row is empty."""

    def __init__(self, starts: np.ndarray, columns: np.ndarray, values: np.ndarray, width: int, leaf: int = LEAF):
        lengths = np.diff(np.append(starts, len(columns)))
        weights = values.astype(np.float64)
        norms = np.add.reduceat(weights * weights, starts)
        order = np.arange(len(starts))
        self.first, self.end, self.children = [0], [len(starts)], [None]
        centers, radii, at = [], [], 0
        while at < len(self.first):
            lo, hi = self.first[at], self.end[at]
            rows = order[lo:hi]
            sizes = lengths[rows]
            places = _flat(starts[rows], sizes)
            cols, vals = columns[places], weights[places]
            heads = np.cumsum(sizes) - sizes

            def distances(point: np.ndarray, norm: float) -> np.ndarray:
                dots = np.add.reduceat(vals * point[cols], heads)
                return np.maximum(norms[rows] - 2 * dots + norm, 0.0)

            center = (np.bincount(cols, weights=vals, minlength=width) / len(rows)).astype(np.float32).astype(np.float64)
            norm = float(center @ center)
            apart = distances(center, norm)
            err = SLACK * (norms[rows] + norm)
            radii.append(math.sqrt(float((apart + err).max())))
            centers.append(center.astype(np.float32))
            if hi - lo > leaf and (apart > 4 * err).any():
                sides = []
                for _ in range(2):
                    pivot = int((sides[0] if sides else apart).argmax())
                    point = np.zeros(width)
                    own = slice(heads[pivot], heads[pivot] + sizes[pivot])
                    point[cols[own]] = vals[own]
                    sides.append(distances(point, norms[rows[pivot]]))
                lean = sides[0] - sides[1]
                left = lean < 0
                if not len(rows) <= 8 * min(left.sum(), len(rows) - left.sum()):
                    left = np.zeros(len(rows), dtype=bool)
                    left[np.argsort(lean, kind="stable")[: len(rows) // 2]] = True
                order[lo:hi] = np.concatenate([rows[left], rows[~left]])
                middle = lo + int(left.sum())
                self.children[at] = (len(self.first), len(self.first) + 1)
                self.first += [lo, middle]
                self.end += [middle, hi]
                self.children += [None, None]
            at += 1
        self.order, self.radii = order, np.array(radii)
        self.centers = np.ascontiguousarray(np.array(centers, dtype=np.float32).T)  # a row for each column of the vectors
        places = _flat(starts[order], lengths[order])
        self.columns, self.values = columns[places], values[places]
        self.starts = np.append(0, np.cumsum(lengths[order]))
        self.scored = 0  # rows whose exact score was asked for

    def bounds(self, at: np.ndarray, counts: np.ndarray) -> list[float]:
        """Of each node: no row below it has a larger product with the query."""
        centers = self.centers[at].astype(np.float64)
        lengths = np.sqrt((counts * counts) @ (centers > 0))
        return ((counts @ centers + lengths * self.radii) * (1 + SLACK) + 1).tolist()

    def search(self, at: np.ndarray, counts: np.ndarray, query: np.ndarray, best: "Best") -> None:
        """Offers all rows that may be among the best; ``query`` has the counts of all columns as whole numbers."""
        bounds = self.bounds(at, counts)
        waiting = [(-bounds[0], 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if -bound < best.least:
                return
            if self.children[node]:
                for child in self.children[node]:
                    most = min(bounds[child], -bound)
                    if most >= best.least:
                        heapq.heappush(waiting, (-most, child))
                continue
            lo, hi = self.first[node], self.end[node]
            starts = self.starts[lo : hi + 1]
            products = self.values[starts[0] : starts[-1]] * query[self.columns[starts[0] : starts[-1]]]
            scores = np.add.reduceat(products, starts[:-1] - starts[0])
            self.scored += hi - lo
            for k in np.flatnonzero(scores >= best.least).tolist():
                best.offer(int(scores[k]), int(self.order[lo + k]))


class Best:
    """The ``k`` highest scores above 0 with their ids, the smaller id first among equals."""

    def __init__(self, k: int):
        self.k, self.kept, self.least = k, [], 1
        self.ids: list = []  # of the rows of the tree that is searched

    def offer(self, score: int, row: int) -> None:
        insort(self.kept, (-score, self.ids[row]))
        if len(self.kept) > self.k:
            self.kept.pop()
        if len(self.kept) == self.k:
            self.least = -self.kept[-1][0]


def impacts(term: np.ndarray, tf: np.ndarray, n: np.ndarray, weights: np.ndarray, documents: int, length: int) -> np.ndarray:
    """Weight of each term times its saturated frequency; ``n`` is the number of terms of its document."""
    m = 25 + (75 * n * documents) // length
    return weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def _search(found: DataFrame, block: list[tuple], vocabulary: dict[bytes, int], weights: np.ndarray, totals: tuple[int, int], top: int) -> DataFrame:
    """Best ``top`` rows of each query in each task: ``(query, id, score)``."""
    width = len(vocabulary)
    queries = [
        (np.array([vocabulary[t] for t in counts], dtype=np.int64), np.array(list(counts.values()), dtype=np.float64))
        for _, counts in block
    ]
    shared = found.sparkSession.sparkContext.broadcast((queries, weights))
    schema = StructType([StructField("query", LongType()), found.schema["id"], StructField("score", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [Best(top) for _ in queries]
        dense = np.zeros(width, dtype=np.int64)
        held: list[tuple] = []
        kind = None

        def through() -> None:
            ids = [i for part in held for i in part[0]]
            sizes, term, value = (np.concatenate([part[k] for part in held]) for k in (1, 2, 3))
            tree = BallTree(np.cumsum(sizes) - sizes, term, value, width)
            for (at, counts), kept in zip(queries, best):
                dense[at] = counts.astype(np.int64)
                kept.ids = ids
                tree.search(at, counts, dense, kept)
                kept.ids = []
                dense[at] = 0
            held.clear()

        for batch in batches:
            kind = batch.schema.field(0).type
            sizes = np.diff(batch.column(2).offsets.to_numpy()).astype(np.int64)
            term = batch.column(2).flatten().to_numpy().astype(np.int64)
            tf = batch.column(3).flatten().to_numpy().astype(np.int64)
            n = np.repeat(batch.column(1).to_numpy(), sizes)
            value = impacts(term, tf, n, weights, *totals)
            named = sizes > 0
            if len(named):
                held.append(([i for i, has in zip(batch.column(0).to_pylist(), named.tolist()) if has], sizes[named], term, value))
            if sum(len(p[0]) for p in held) >= BLOCK or sum(len(p[2]) for p in held) >= BLOCK_ENTRIES:
                through()
        if held and any(len(p[0]) for p in held):
            through()
        rows = [(k, doc, -score) for k, kept in enumerate(best) for score, doc in kept.kept]
        columns = list(zip(*rows)) if rows else [[], [], []]
        if kind is not None:
            arrays = [pa.array(list(c), t) for c, t in zip(columns, (pa.int64(), kind, pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["query", "id", "score"])

    return found.where("id IS NOT NULL").select("id", "n", "term", "tf").mapInArrow(run, schema)


def _best(rows: DataFrame, top: int) -> DataFrame:
    """The best ``top`` rows of each query with their rank; first in parts, so that no task gets all of a query."""
    order = (F.desc("score"), F.asc("id"))
    salted = Window.partitionBy("query", F.pmod(F.xxhash64("id"), F.lit(SALTS))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)))
    return rows.where(F.col("rank") <= top)


def ranked_search(
    docs: DataFrame,
    queries: DataFrame,
    top: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    query_id: str = "item_id",
    query_text: str = "text",
) -> DataFrame:
    """``(query_id, rank, id, score)``: the ``top`` documents of each query with a score above 0, ties by id."""
    small_batches(docs)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    parts = []
    for block in query_blocks(queries, query_id, query_text):
        known = dict.fromkeys(t for _, counts in block for t in counts)
        vocabulary = {t: k for k, t in enumerate(known)}
        found = stage(vectors(texts, vocabulary), "vectors")
        documents, length = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not documents:
            continue
        frequency = np.zeros(len(vocabulary), dtype=np.int64)
        for term, df in found.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # VOCABULARY rows
            frequency[term] = df
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequency.tolist()], dtype=np.int64)
        rows = _best(_search(found, block, vocabulary, weights, (documents, length), top), top)
        names = spark.createDataFrame(
            [(k, i) for k, (i, _) in enumerate(block)], StructType([StructField("query", LongType()), StructField("q", queries.schema[query_id].dataType)])
        )
        rows = rows.join(F.broadcast(names), "query")  # at most QUERIES rows
        parts.append(stage(rows.select(F.col("q").alias("query_id"), "rank", "id", "score"), "ranked"))
    if parts:
        return reduce(DataFrame.unionByName, parts)
    kinds = [("query_id", queries.schema[query_id]), ("id", docs.schema[id_col])]
    (q, i) = (f"{n} {f.dataType.simpleString()}" for n, f in kinds)
    return spark.createDataFrame([], f"{q}, rank int, {i}, score long")
