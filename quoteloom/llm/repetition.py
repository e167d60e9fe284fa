"""Quality rules on repetition inside a text, from its suffix array over words.

The texts of a batch are sorted together, as far as their suffixes are not yet told apart, by prefix doubling; the
ranks of each doubling give the longest common prefix of neighbours. A position's longest repeat is the longer of
its two neighbours' common prefixes. Runs of positions that belong to one repeat count from their first position, so
the spans are those of maximal repeated substrings; their union gives the share of words that repeats cover.

Defined results: a NULL or blank text has no words and fails; a NULL id stays NULL; repeated rows are judged each;
an empty table gives no rows; other columns are ignored. Texts are taken whole; a long one is sorted alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import chunks, segment_ids, small_batches

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\x0b\x0c\r"


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, ranks and the ranks after each doubling.

    ``words`` are numbers of words, different in different texts; ``ends`` gives for each position the end of its
    text, where its suffix ends too.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    new = np.ones(n, dtype=bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    starts = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, step = [rank.copy()], 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        open_slots = sizes[rank[order]] > 1
        active = order[open_slots]
        if not len(active):
            return order, rank, levels
        slots = np.flatnonzero(open_slots)
        ahead = active + step
        inside = ahead < ends[active]
        following = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        by = np.lexsort((following, rank[active]))
        active, following, held = active[by], following[by], rank[active][by]
        new = np.ones(len(active), dtype=bool)
        new[1:] = (held[1:] != held[:-1]) | (following[1:] != following[:-1])
        starts = np.flatnonzero(new)
        order[slots] = active
        rank[active] = np.repeat(slots[starts], np.diff(np.append(starts, len(active))))
        levels.append(rank.copy())
        step *= 2


def longest_repeats(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position, the number of words from there on that stand in the text once more."""
    n = len(words)
    if n < 2:
        return np.zeros(n, dtype=np.int64)
    order, _, levels = suffix_order(words, ends)
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        common[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    longest = np.zeros(n, dtype=np.int64)
    longest[order[:-1]] = common
    longest[order[1:]] = np.maximum(longest[order[1:]], common)
    return longest


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a span ``[start, start + length)``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    return np.cumsum(change[:-1]) > 0


def maximal_starts(longest: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions whose repeat does not go on from the position before; ``first`` marks the starts of texts."""
    goes_on = np.zeros(len(longest), dtype=bool)
    goes_on[1:] = longest[:-1] == longest[1:] + 1
    return ~goes_on | first


def _measures(texts: list[str], min_words: int) -> list[np.ndarray]:
    """Per text: words, word characters, symbols, repeated lines, words in repeated windows, covered, longest."""
    raw = [t.encode() for t in texts]
    split = [r.split() for r in raw]
    counts = np.array([len(s) for s in split])
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for s in split for w in s), np.int64, int(counts.sum()))
    text = segment_ids(counts)
    ends = np.cumsum(counts)[text] if len(flat) else flat
    longest = longest_repeats(flat + text * max(len(numbers), 1), ends)
    in_window = np.flatnonzero(longest >= 3)
    window = covered(in_window, np.full(len(in_window), 3), len(flat))
    first = np.ones(len(flat), dtype=bool)
    first[1:] = text[1:] != text[:-1]
    spans = np.flatnonzero((longest >= min_words) & maximal_starts(longest, first))
    span = covered(spans, longest[spans], len(flat))
    most = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(most, text, longest)
    lines = [[x for x in r.split(b"\n") if x.strip()] for r in raw]
    return [
        counts,
        np.array([len(t) - (len(r) - len(r.translate(None, BLANKS))) for t, r in zip(texts, raw)]),
        np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw]),
        np.array([len(x) - len(set(x)) for x in lines]),
        np.bincount(text, weights=window, minlength=len(texts)),
        np.bincount(text, weights=span, minlength=len(texts)),
        most,
    ]


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat")


def repetition_measures(
    df: DataFrame, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id`` and :data:`MEASURES` of every row; repeats of at least ``min_words`` words count as covering."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                found = [pa.array(x.astype(np.int64)) for x in _measures(texts[a:b], min_words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *found], ["id", *MEASURES])

    small_batches(df)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))


def repetition_verdicts(
    df: DataFrame,
    max_covered: float = 0.3,
    max_longest: int = 200,
    min_words: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The measures with ``base_failed`` and ``kept``.

    The base fails below 50 words, or if over half of the words stand in repeated windows of three. Beyond that a
    text is kept if repeats of ``min_words`` words or more cover at most the share ``max_covered`` of its words and
    none is longer than ``max_longest`` words.
    """
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("covered_words") <= max_covered * F.col("n_words")) & (F.col("longest_repeat") <= max_longest)
    measures = repetition_measures(df, min_words, id_col, text_col)
    return measures.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & fine)
