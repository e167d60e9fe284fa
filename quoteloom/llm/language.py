"""Language proportions of texts: expectation-maximisation over words, language set by penalised likelihood.

Learning counts letter bigrams and trigrams (hashed) per language over labelled texts. A word's likelihood in each
language is the tempered product over its letters; a text is a mixture of languages, each word coming from one of
them. Expectation-maximisation gives the shares. From the set of all languages the one with the smallest share is
taken out again and again down to a single one, and of all these sets the one with the best likelihood less half a logarithm of the word count for each
language stays. The prediction is the language with the largest share, the score is that share.

Learning takes about ``max_docs`` texts of each language (those whose hashed id falls below a share of the
language's count), so its cost is bounded; every text is scored whole.

Defined results: a NULL text, one without a letter, and any text when nothing was learned give ``und`` with score
0 and no languages; rows without an id or language are not learned from; a NULL id stays NULL; repeated rows are
scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import chunks, segment_ids, small_batches

BUCKETS = 1 << 16  # for each of the two orders
UNKNOWN = "und"
# Languages that can be learned: each takes 512 KB in the driver and in every task.
MAX_LANGUAGES = 256


@dataclass
class Letters:
    """The letters of several texts: features of each, and how they form words and texts."""

    trigrams: np.ndarray
    bigrams: np.ndarray
    word_starts: np.ndarray  # number of the first letter of each word
    words: np.ndarray  # per text


def letters(texts: list[str]) -> Letters:
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if not len(points):
        none = np.zeros(0, dtype=np.int64)
        return Letters(none, none, none, np.zeros(len(texts), dtype=np.int64))
    present = np.flatnonzero(np.bincount(points))
    alpha = np.zeros(present[-1] + 1, dtype=bool)
    alpha[present] = [chr(c).isalpha() for c in present.tolist()]
    is_letter = alpha[points]
    padded = np.zeros(len(points) + 2, dtype=np.uint64)
    padded[1:-1] = np.where(is_letter, points, 0)
    at = np.flatnonzero(is_letter)
    before, own, after = padded[at], padded[at + 1], padded[at + 2]
    mix = own * np.uint64(0x9E3779B97F4A7C15) + after * np.uint64(0xC2B2AE3D27D4EB4F)
    bigrams = (mix >> np.uint64(48)).astype(np.int64) + BUCKETS
    trigrams = ((mix + before * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(48)).astype(np.int64)
    word_starts = np.flatnonzero(before == 0)
    text_starts = np.cumsum([0] + [len(t) + 1 for t in lowered])[:-1]
    words = np.bincount(np.searchsorted(text_starts, at[word_starts], side="right") - 1, minlength=len(texts))
    return Letters(trigrams, bigrams, word_starts, words)


def mixtures(word_logs: np.ndarray, words: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares ``(texts, languages)`` of the chosen set, and its penalised log-likelihood.

    ``word_logs`` are log-likelihoods ``(all words, languages)``; ``words`` counts them for each text, 1 at least.
    """
    top = word_logs.max(axis=1, keepdims=True)
    likely = np.exp(word_logs - top)
    starts = np.concatenate([[0], np.cumsum(words)[:-1]])
    text = segment_ids(words)
    n_languages = likely.shape[1]
    shares = np.full((len(words), n_languages), 1 / n_languages, dtype=likely.dtype)
    best, best_value = shares, np.full(len(words), -np.inf)
    for size in range(n_languages, 0, -1):
        if size < n_languages:
            keep = np.argsort(-shares, axis=1, kind="stable")[:, :size]
            mask = np.zeros_like(shares)
            np.put_along_axis(mask, keep, 1.0, axis=1)
            shares = np.maximum(shares, 1e-6) * mask
            shares /= shares.sum(axis=1, keepdims=True)
        for _ in range(rounds if size > 1 else 0):
            part = likely * shares[text]
            part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-30)
            shares = np.add.reduceat(part, starts, axis=0) / words[:, None]
        total = np.log(np.maximum((likely * shares[text]).sum(axis=1), 1e-30))
        value = np.add.reduceat(total, starts) - 0.5 * size * np.log(words + 1)
        better = value > best_value
        best = np.where(better[:, None], shares, best)
        best_value = np.where(better, value, best_value)
    return best, best_value


def learn(df: DataFrame, languages: list[str], id_col: str, text_col: str, lang_col: str) -> np.ndarray:
    """Log-probabilities ``(2 * BUCKETS, languages)`` from all rows of ``df``."""
    number = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), 2 * BUCKETS), dtype=np.int64)
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in chunks(texts):
                for name in set(langs[a:b]):
                    found = letters([t for t, x in zip(texts[a:b], langs[a:b]) if x == name])
                    for places in (found.trigrams, found.bigrams):
                        totals[number[name]] += np.bincount(places, minlength=2 * BUCKETS)
        lang, place = np.nonzero(totals)
        arrays = [pa.array(lang.astype(np.int32)), pa.array(place.astype(np.int32)), pa.array(totals[lang, place])]
        yield pa.RecordBatch.from_arrays(arrays, ["lang", "place", "n"])

    rows = df.select(text_col, lang_col).mapInArrow(count, "lang int, place int, n long")
    table = rows.groupBy("lang", "place").agg(F.sum("n").alias("n")).toArrow()  # 2 * BUCKETS rows a language at most
    counts = np.zeros((2 * BUCKETS, len(languages)))
    counts[table["place"].to_numpy(), table["lang"].to_numpy()] = table["n"].to_numpy()
    logs = np.empty_like(counts)
    for part in (slice(0, BUCKETS), slice(BUCKETS, 2 * BUCKETS)):
        smoothed = counts[part] + 0.05
        logs[part] = np.log(smoothed / smoothed.sum(axis=0))
    return logs.astype(np.float32)


def identify_languages(
    df: DataFrame,
    labelled: DataFrame,
    max_docs: int = 2000,
    rounds: int = 6,
    temper: float = 0.4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """``(id, lang, score, langs, shares)`` of every row of ``df``, learned from the rows of ``labelled``.

    ``langs`` and ``shares`` give the chosen set, largest share first. More than ``MAX_LANGUAGES`` different values of
    the language column are an error.
    """
    small_batches(df)
    spark = df.sparkSession
    known = labelled.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    counts = dict(known.groupBy(lang_col).count().limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn; put spellings of one language together first")
    languages = sorted(counts)
    rate: Column = F.lit(0)
    for name in languages:
        rate = F.when(F.col(lang_col) == name, min(1 << 30, (max_docs << 30) // counts[name])).otherwise(rate)
    sample = known.where(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < rate)
    logs = spark.sparkContext.broadcast(learn(sample, languages, id_col, text_col, lang_col) if languages else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                found = letters(texts[a:b])
                has = np.flatnonzero(found.words) if languages else np.zeros(0, dtype=np.int64)
                preds, scores = [UNKNOWN] * (b - a), np.zeros(b - a)
                sets: list[list[str]] = [[] for _ in preds]
                parts: list[list[float]] = [[] for _ in preds]
                if len(has):
                    table = logs.value
                    by_letter = table[found.trigrams] + table[found.bigrams]
                    word_logs = np.add.reduceat(by_letter, found.word_starts, axis=0) * np.float32(temper)
                    shares, _ = mixtures(word_logs, found.words[has], rounds)
                    ranked = np.argsort(-shares, axis=1, kind="stable").tolist()
                    for k, order, row in zip(has.tolist(), ranked, shares.tolist()):
                        chosen = [x for x in order if row[x] > 0]
                        preds[k], scores[k] = languages[chosen[0]], min(1.0, row[chosen[0]])
                        sets[k], parts[k] = [languages[x] for x in chosen], [row[x] for x in chosen]
                columns = [
                    batch.column(0).slice(a, b - a),
                    pa.array(preds, pa.string()),
                    pa.array(scores),
                    pa.array(sets, pa.list_(pa.string())),
                    pa.array(parts, pa.list_(pa.float64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "lang", "score", "langs", "shares"])

    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, lang string, score double, langs array<string>, shares array<double>")
