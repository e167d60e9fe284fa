"""Phrases whose words stand together more often than their parts alone, counted in suffix subtrees.

Phrase counts come from the tree of all suffixes of the word sequence, cut off at ``depth`` words. The tree is built in
parts that fit into memory, by vertical partitioning:

1. Words are counted. Only words with ``least`` occurrences can be in a phrase that counts; a bit filter of them goes to
   the next scan.
2. Prefixes of two such words are counted by hash. Those below ``least`` have no subtree. A prefix with more suffixes
   than a group's budget is extended by one more word, and if need be by another one.
3. Prefixes are grouped by ranges of their hash so that no group gets more suffixes than its budget. A scan sends each
   suffix, cut where no phrase can go on, to its prefix's group; equal suffixes of a task travel as one row with their
   number.
4. Each group sorts its suffixes, which makes its subtree, and reads each phrase's count from the leaf totals below.

A prefix is never judged by a filter alone: filters and hashes only decide what travels and where; phrases and counts
are exact. The word filter has 16 bits a word and at most ``MAX_FILTER_BITS``; when it is denser more rows travel. The
filter of prefixes is cut into hash ranges that fit, with one scan for each, so the budget holds at any size.

Defined results: a NULL text is empty, a NULL language is ``und``; repeated rows count as often as they come; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quoteloom.llm.common import bit_filter, has_places, mixed, places, small_batches
from quoteloom.session import stage

SEED = 42
# Words that a task works on at once.
CHUNK = 1_000_000
MIN_FILTER_BITS, MAX_FILTER_BITS, BITS_EACH = 1 << 18, 1 << 30, 16
# Suffixes of a group, and groups for each shuffle partition (small groups even out).
GROUP_SUFFIXES, GROUPS_EACH = 1_000_000, 8
# Ranges of prefix hashes that groups are made of, for each group.
RANGES_EACH = 64
SALTS = 64
BREAK = 0
_FOLD = bytes(k + 32 if 65 <= k <= 90 else 10 if k in b".,;:!?\x0a\x0b\x0c\x0d" else 32 if k == 9 else k for k in range(256))


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def numbered(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """All words and the sequence of their numbers; number 0 stands between pieces and texts."""
    numbers = _Numbers({b"\n": BREAK, b"": 1})
    tokens = b" \n ".join(t.translate(_FOLD).replace(b"\n", b" \n ") for t in texts).split(b" ")
    ids = np.fromiter(map(numbers.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    return list(numbers), ids[ids != 1]


def word_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """``(language, words, numbers)`` of about :data:`CHUNK` words, from batches of language and text."""
    held: dict[str, list[bytes]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            data = text.encode()
            held.setdefault(lang, []).append(data)
            size += len(data)
            if size >= 6 * CHUNK:
                for known, texts in held.items():
                    yield known, *numbered(texts)
                held, size = {}, 0
    for known, texts in held.items():
        yield known, *numbered(texts)


def word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    """What Spark's ``xxhash64(lang, word)`` gives, unsigned; 0 for the two that are no words."""
    seed = xxhash.xxh64_intdigest(lang.encode(), SEED)
    digest = xxhash.xxh64_intdigest
    return np.array([0, 0, *(digest(w, seed) for w in words[2:])], dtype=np.uint64)


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a prefix that grows by one word."""
    with np.errstate(over="ignore"):
        return mixed(left * np.uint64(0x9E3779B97F4A7C15) + right)


def filter_size(n: int) -> int:
    return max(MIN_FILTER_BITS, 1 << max(0, BITS_EACH * n - 1).bit_length())


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, f)``: occurrences of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in word_chunks(batches):
            counts = np.bincount(ids, minlength=len(words))[2:]
            names = pa.array(words[2:], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(names), pa.string()), names, pa.array(counts, pa.int64())], ["lang", "word", "f"])

    counted = rows.mapInArrow(run, "lang string, word string, f long")
    return counted.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def prefix_counts(rows: DataFrame, words_filter, bits: int, heavy) -> DataFrame:
    """``(h, f)``: hash and occurrences of each prefix of two frequent words, or of three below a heavy one of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in word_chunks(batches):
            hashes = word_hashes(lang, words)
            often = has_places(words_filter.value, places(hashes, bits))
            often[:2] = False
            good = often[ids]
            pair = np.flatnonzero(good[:-1] & good[1:])
            found = joined(hashes[ids[pair]], hashes[ids[pair + 1]])
            if heavy is not None:
                keep = np.isin(found, heavy.value) & (pair + 2 < len(ids)) & good[np.minimum(pair + 2, len(ids) - 1)]
                found = joined(found[keep], hashes[ids[pair[keep] + 2]])
            found, counts = np.unique(found, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts, pa.int64())], ["h", "f"])

    return rows.mapInArrow(run, "h long, f long").groupBy("h").agg(F.sum("f").alias("f"))


class Grouping:
    """Where suffixes go: ``heavy`` prefixes of two and three words are extended, ranges of hashes make the groups."""

    def __init__(self, heavy_two: np.ndarray, heavy_three: np.ndarray, load: np.ndarray, budget: int):
        self.two, self.three = np.sort(heavy_two), np.sort(heavy_three)
        self.bits = len(load).bit_length() - 1
        self.group = np.zeros(len(load), dtype=np.int32)
        group = held = 0
        for k, n in enumerate(load.tolist()):
            if held and held + n > budget:
                group, held = group + 1, 0
            held += n
            self.group[k] = group
        self.groups = group + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        return self.group[(mixed(hashes) >> np.uint64(64 - self.bits)).astype(np.int64)]


def suffixes(rows: DataFrame, words_filter, bits: int, prefixes_filter, prefix_bits: int, span: tuple[int, int], grouping, depth: int) -> DataFrame:
    """``(g, lang, phrase, words, first, f)``: suffixes of a group, cut, with their number; they count from ``first`` words on."""
    lo, hi = span
    whole = hi - lo == prefix_bits

    def cut(lang: str, words: list[bytes], ids: np.ndarray) -> pa.RecordBatch | None:
        hashes = word_hashes(lang, words)
        often = has_places(words_filter.value, places(hashes, bits))
        often[:2] = False
        good = often[ids]
        at = np.flatnonzero(good[:-1] & good[1:])
        two = joined(hashes[ids[at]], hashes[ids[at + 1]])
        place = places(two, prefix_bits)
        mine = (place >= lo) & (place < hi)
        mine[mine] = has_places(prefixes_filter.value, place[mine] - lo)
        follows = np.zeros(len(ids) + depth, dtype=bool)  # the pair that begins here can be part of a phrase
        follows[at] = mine if whole else True
        at, two = at[mine], two[mine]
        length = np.full(len(at), 2)
        for d in range(1, depth - 1):
            length += (length == d + 1) & follows[at + d]
        padded = np.concatenate([ids, np.zeros(depth, dtype=np.int64)])
        longer = [(at, length, np.full(len(at), 2), two)]
        plan: Grouping = grouping.value
        for heavy, d in ((plan.two, 2), (plan.three, 3)):
            where, size, first, h = longer.pop()
            is_heavy = np.isin(h, heavy) if d < depth else np.zeros(len(h), bool)
            longer.append((where[~is_heavy], size[~is_heavy], first[~is_heavy], h[~is_heavy]))
            longer.append((where[is_heavy], np.full(int(is_heavy.sum()), d), first[is_heavy], h[is_heavy]))
            more = is_heavy & (size > d)
            longer.append((where[more], size[more], np.full(int(more.sum()), d + 1), joined(h[more], hashes[padded[where[more] + d]])))
        at, length, first, h = (np.concatenate(x) for x in zip(*longer))
        if not len(at):
            return None
        groups = plan.of(h)
        columns = [np.where(length > d, padded[at + d], 0) for d in range(depth)]
        order = np.lexsort((first, *columns))
        columns = [c[order] for c in columns]
        length, first, groups = length[order], first[order], groups[order]
        new = np.ones(len(at), dtype=bool)
        new[1:] = first[1:] != first[:-1]
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        heads = np.flatnonzero(new)
        counts = np.diff(np.append(heads, len(at)))
        known = pa.array(words, pa.binary()).cast(pa.string())
        missing = [length[heads] <= d for d in range(depth)]
        parts = [known.take(pa.array(c[heads], mask=gone)) for c, gone in zip(columns, missing)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(groups[heads], pa.int32()),
                pa.array([lang], pa.string()).take(pa.array(np.zeros(len(heads), dtype=np.int32))),
                pc.binary_join_element_wise(*parts, " ", null_handling="skip"),
                pa.array(length[heads], pa.int32()),
                pa.array(first[heads], pa.int32()),
                pa.array(counts, pa.int64()),
            ],
            ["g", "lang", "phrase", "words", "first", "f"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in word_chunks(batches):
            if (out := cut(lang, words, ids)) is not None:
                yield from pa.Table.from_batches([out]).to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, "g int, lang string, phrase string, words int, first int, f long")


def subtree_counts(suffixes: pa.Table, depth: int, least: int) -> list[tuple[str, str, int, int]]:
    """``(lang, phrase, words, count)`` of the nodes from two words on with at least ``least`` leaves below."""
    length, first, f = (suffixes[c].to_numpy() for c in ("words", "first", "f"))
    tongues = suffixes["lang"].combine_chunks().dictionary_encode()
    tongue = tongues.indices.to_numpy()
    tokens = " ".join(suffixes["phrase"].to_pylist()).split(" ")
    numbers = _Numbers()
    ids = np.fromiter(map(numbers.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    table = np.zeros((depth, len(length)), dtype=np.int64)
    starts = np.cumsum(length) - length
    for d in range(depth):
        has = length > d
        table[d, has] = ids[starts[has] + d] + 1
    order = np.lexsort((*table[::-1], tongue))  # the sorted suffixes; a node is a run with equal first words
    names, langs, out = list(numbers), tongues.dictionary.to_pylist(), []
    for d in range(2, depth + 1):
        rows = order[length[order] >= d]
        if not len(rows):
            break
        keys = np.vstack([tongue[rows], table[:d, rows]])
        heads = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        totals = np.add.reduceat(np.where(first[rows] <= d, f[rows], 0), heads)
        for k in np.flatnonzero(totals >= least).tolist():
            row = rows[heads[k]]
            out.append((langs[tongue[row]], " ".join(names[x - 1] for x in table[:d, row].tolist()), d, int(totals[k])))
    return out


def _counted(rows: DataFrame, groups: int, depth: int, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            found = subtree_counts(pa.Table.from_batches(held), depth, least)
            columns = zip(*found) if found else [[]] * 4
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["lang", "phrase", "words", "f"])

        at, held = None, []
        for batch in batches:
            g = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(g)) + 1).tolist(), len(g)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if held and g[lo] != at:
                    yield out(held)
                    held = []
                at = g[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield out(held)

    return rows.repartition(groups, "g").sortWithinPartitions("g").mapInArrow(run, "lang string, phrase string, words int, f long")


def phrase_counts(df: DataFrame, least: int = 30, depth: int = 4, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """All words ``(lang, word, f)``, and all phrases of 2 to ``depth`` words that occur ``least`` times or more: ``(lang, phrase, words, f)``."""
    if least < 1 or depth not in (2, 3, 4):
        raise ValueError("least must be at least 1, depth 2 to 4")
    small_batches(df)
    spark = df.sparkSession
    context = spark.sparkContext
    rows = df.where(F.length(text_col) > 0).select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    words = stage(word_counts(rows), "words")
    often = words.where(F.col("f") >= least)
    bits = min(MAX_FILTER_BITS, filter_size(often.count()))
    words_filter = context.broadcast(bit_filter(often.select(F.xxhash64("lang", "word").alias("h")), bits))

    two = stage(prefix_counts(rows, words_filter, bits, None).where(F.col("f") >= least), "prefixes")
    n_two, total = two.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(GROUPS_EACH * partitions, -(-total // GROUP_SUFFIXES))
    budget = max(1, -(-total // groups))
    # At most one prefix a group is over the budget.
    heavy = lambda counts: np.array([r.h for r in counts.where(F.col("f") > budget).collect()], dtype=np.int64).view(np.uint64)
    heavy_two, heavy_three, light = heavy(two), np.zeros(0, dtype=np.uint64), two.where(F.col("f") <= budget)
    if len(heavy_two) and depth > 2:
        three = stage(prefix_counts(rows, words_filter, bits, context.broadcast(heavy_two)), "longer-prefixes")
        heavy_three = heavy(three)
        light = light.unionByName(three.where(F.col("f") <= budget))
    ranges = 1 << (RANGES_EACH * groups - 1).bit_length()
    load = np.zeros(ranges, dtype=np.int64)
    for k, n in _range_loads(light, ranges).collect():  # a number for each of 64 to 128 ranges a group
        load[k] = n
    grouping = context.broadcast(Grouping(heavy_two, heavy_three, load, budget))

    prefix_bits = filter_size(n_two)
    found = None
    for lo in range(0, prefix_bits, MAX_FILTER_BITS):
        hi = min(prefix_bits, lo + MAX_FILTER_BITS)
        prefixes_filter = context.broadcast(bit_filter(two.select("h"), prefix_bits, lo, hi))
        cut = suffixes(rows, words_filter, bits, prefixes_filter, prefix_bits, (lo, hi), grouping, depth)
        part = stage(_counted(cut, partitions, depth, least), "phrases")
        found = part if found is None else found.unionByName(part)
    return words, found


def _range_loads(light: DataFrame, ranges: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(ranges, dtype=np.int64)
        shift = np.uint64(65 - ranges.bit_length())
        for batch in batches:
            h = batch.column(0).to_numpy().view(np.uint64)
            np.add.at(load, (mixed(h) >> shift).astype(np.int64), batch.column(1).to_numpy())
        some = np.flatnonzero(load)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(load[some], pa.int64())], ["k", "n"])

    return light.select("h", "f").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def collocations(
    df: DataFrame,
    least: int = 30,
    depth: int = 4,
    top: int = 2000,
    covered_percent: int = 80,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts of its weakest cut, ``n`` all words of the language; the
    score is ``floor(2000000 a / (l + r))``. A phrase that stands inside a longer one with ``covered_percent`` of its
    count or more is left out.
    """
    words, phrases = phrase_counts(df, least, depth, lang_col, text_col)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    counts = words.where(F.col("f") >= least).select("lang", F.col("word").alias("part"), F.col("f").alias("count"))
    counts = stage(counts.unionByName(phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias("count"))), "counts")

    w = F.split("phrase", " ")
    slice_ = lambda first, n: F.array_join(F.slice(w, first, n), " ")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(k.alias("k"), slice_(F.lit(1), k).alias("left"), slice_(k + 1, F.col("words") - k).alias("right")))
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), F.explode(cuts).alias("cut")).select("lang", "phrase", "a", "cut.*")
    side = lambda name, to: counts.select("lang", F.col("part").alias(name), F.col("count").alias(to))
    cut = cut.join(side("left", "l"), ["lang", "left"]).join(side("right", "r"), ["lang", "right"])
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    score = F.expr("cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0)) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = cut.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))

    longer = phrases.where("words > 2")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("words") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("words") - n + 1), lambda k: slice_(k, n)),
        )
    )
    inside = longer.select("lang", "f", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.col("over").isNull() | (wide("over") * 100 < wide("a") * covered_percent))

    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = kept.select("lang", "phrase", "a", "least.l", "least.r", "least.score")
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    kept = kept.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
