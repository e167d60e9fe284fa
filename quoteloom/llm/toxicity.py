"""Toxicity by a learned lexicon whose trie is walked together with Levenshtein automata.

Learning takes labelled texts and counts, for words and word beginnings, in how many of them they stand (beginnings
also: in how many they stand twice or three times, with more letters behind). An entry is taken when most of these
are toxic and chance can't explain it (a Chernoff bound over all candidates). Of nested beginnings only the one that
chance explains least is taken. An entry whose word mostly stands alone is a term: misspellings within an edit
distance that grows with its length count too. Any other is a stem, which words must begin with exactly, as often as
it was learned.

Matching runs a word through the automaton of all entries at once: a state is the set of (trie node, edits so far),
states are made when first met and kept. Most words end in the dead state within three letters.

Scoring looks at the words around a match. A match in quotation marks or behind a word of reporting is a mention; of
those only the strongest counts, at a reduced weight. Other matches add up as independent evidence, more so beside a
word of address. The score is the chance that at least one piece of evidence holds.

Learning takes about ``max_labelled`` toxic and twice as many other labelled texts (those whose hashed id falls below a share of the
class's count); near copies among them, found by equal minima of shingle hashes, count once. Every text is scored
whole.

Defined results: a NULL or empty text has no match and gets the score of texts without any; so does every text
when there are no labels of both classes; rows without an id are not learned from; a NULL id stays NULL; repeated
rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quoteloom.llm.common import small_batches
from quoteloom.session import stage

# A word may hold digits, and symbols between two word characters.
WORD = re.compile(r"[^\W_]+(?:[*@$!]+[^\W_]+)*")
STEM_LETTERS = range(3, 11)
NO_MATCH = 0.01
FUZZY_PRIOR = 0.45
# Share of toxic texts that an entry needs, and how often a stem may be needed in a text.
LEAST_SHARE, MOST_REPEATS = 0.8, 3
MENTION, ADDRESS = 0.4, 0.5
# Fixed word lists.
QUOTE_MARKS = frozenset("\"'`‘’‚“”„«»‹›")
REPORTING = frozenset(
    "word words term terms called calls said says quote quoted quotes wrote slur insult insults "
    "mot mots terme dit disait insulte palabra palabras dijo dice insulto wort worte sagte sagt begriff".split()
)
ADDRESSING = frozenset("you your yours youre u ur tu toi vous ton ta usted ustedes du dich dir ihr euch".split())


@dataclass
class Entry:
    text: str
    stem: bool
    weight: float
    need: int = 1  # words that must begin with a stem
    fuzzy_weight: float = FUZZY_PRIOR

    @property
    def edits(self) -> int:
        return 0 if self.stem or len(self.text) < 5 else 1 if len(self.text) < 12 else 2


@dataclass
class Node:
    children: dict[str, "Node"] = field(default_factory=dict)
    entries: list[int] = field(default_factory=list)
    edits: int = 0  # most that an entry below allows


class Automaton:
    """All entries' Levenshtein automata over their common trie, made deterministic step by step."""

    DEAD = 0

    def __init__(self, entries: list[Entry], most_states: int = 200_000):
        self.entries, self.most_states = entries, most_states
        self.root = Node()
        for k, entry in enumerate(entries):
            node = self.root
            node.edits = max(node.edits, entry.edits)
            for ch in entry.text:
                node = node.children.setdefault(ch, Node())
                node.edits = max(node.edits, entry.edits)
            node.entries.append(k)
        self._reset()

    def _reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[dict[int, tuple[Node, int]]] = []
        self.steps: dict[tuple[int, str], int] = {}
        self.found: list[tuple[list[int], list[tuple[int, int]]]] = []
        self._state({})
        self.start = self._state({id(self.root): (self.root, 0)})
        self.alive: dict[str, bool] = {}

    def _state(self, nodes: dict[int, tuple[Node, int]]) -> int:
        todo = list(nodes.values())
        while todo:  # letters of the entry that the word leaves out
            node, edits = todo.pop()
            for child in node.children.values():
                if edits < child.edits and nodes.get(id(child), (child, 99))[1] > edits + 1:
                    nodes[id(child)] = (child, edits + 1)
                    todo.append((child, edits + 1))
        key = frozenset((k, e) for k, (_, e) in nodes.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.sets)
            self.sets.append(nodes)
            stems = [k for n, e in nodes.values() if e == 0 for k in n.entries if self.entries[k].stem]
            terms = [(k, e) for n, e in nodes.values() for k in n.entries if not self.entries[k].stem and e <= self.entries[k].edits]
            self.found.append((stems, terms))
        return self.numbers[key]

    def step(self, state: int, ch: str) -> int:
        to = self.steps.get((state, ch))
        if to is None:
            nodes: dict[int, tuple[Node, int]] = {}

            def add(node: Node, edits: int) -> None:
                if edits <= node.edits and nodes.get(id(node), (node, 99))[1] > edits:
                    nodes[id(node)] = (node, edits)

            for node, edits in self.sets[state].values():
                add(node, edits + 1)
                for letter, child in node.children.items():
                    add(child, edits + (letter != ch))
            to = self.steps[state, ch] = self._state(nodes)
        return to

    def is_alive(self, head: str) -> bool:
        """Whether a word that begins with ``head`` can match."""
        known = self.alive.get(head)
        if known is None:
            if len(self.sets) > self.most_states:
                self._reset()
            state, known = self.start, False
            for ch in head:
                state = self.step(state, ch)
                known = known or bool(self.found[state][0])
            known = self.alive[head] = known or state != self.DEAD
        return known

    def match(self, word: str) -> list[tuple[int, int]]:
        """(entry, edits) of all matches; a stem that is needed more than once needs letters behind it."""
        state, found, last = self.start, [], len(word) - 1
        for k, ch in enumerate(word):
            state = self.step(state, ch)
            found += [(e, 0) for e in self.found[state][0] if k < last or self.entries[e].need == 1]
            if state == self.DEAD:
                break
        return found + self.found[state][1]

    def weight(self, match: tuple[int, int]) -> float:
        entry = self.entries[match[0]]
        return entry.fuzzy_weight if match[1] else entry.weight


def matches(automaton: Automaton, lowered: str) -> dict[str, list[tuple[int, int]]]:
    """The words of a text that match, with their matches."""
    is_alive, out = automaton.is_alive, {}
    for word in set(WORD.findall(lowered)):
        if is_alive(word[:3]):
            found = automaton.match(word)
            if found:
                out[word] = found
    return out


def score(automaton: Automaton, text: str | None) -> tuple[float, list[tuple[int, int, str, bool]]]:
    """Score of a text, and its matches as (start, end, entry, mentioned)."""
    if not text:
        return NO_MATCH, []
    lowered = text.lower()
    hits = matches(automaton, lowered)
    if not hits:
        return NO_MATCH, []
    words = [(m.group(), m.start(), m.end()) for m in WORD.finditer(lowered)]
    often = Counter(e for word, _, _ in words for e, _ in hits.get(word, ()))
    entries, clean, mention, spans = automaton.entries, 1.0, 0.0, []
    repeated: set[int] = set()
    for k, (word, start, end) in enumerate(words):
        # The strongest of the word's matches counts; a stem that is needed several times counts once.
        found = [m for m in hits.get(word, ()) if often[m[0]] >= entries[m[0]].need and m[0] not in repeated]
        if not found:
            continue
        best = max(found, key=lambda m: (automaton.weight(m), -m[0]))
        entry, weight = entries[best[0]], automaton.weight(best)
        if entry.need > 1:
            repeated.add(best[0])
        around = [w for w, _, _ in words[max(0, k - 3) : k]]
        quoted = start > 0 and end < len(lowered) and lowered[start - 1] in QUOTE_MARKS and lowered[end] in QUOTE_MARKS
        mentioned = quoted or not REPORTING.isdisjoint(around)
        if mentioned:
            mention = max(mention, weight * MENTION)
        else:
            around += [w for w, _, _ in words[k + 1 : k + 4]]
            clean *= (1 - weight) * (1 if ADDRESSING.isdisjoint(around) else ADDRESS)
        spans.append((start, end, entry.text, mentioned))
    if not spans:
        return NO_MATCH, []
    return 1 - (1 - NO_MATCH) * clean * (1 - mention), spans


def _candidates(text: str) -> list[str]:
    """Words (``=word``), their beginnings (``1beginning``) and beginnings that repeat (``2...``, ``3...``)."""
    words = WORD.findall(text.lower())
    once = set(words)
    often = Counter(w[:n] for w in words for n in STEM_LETTERS if len(w) > n)
    return (
        [f"={w}" for w in once if len(w) <= 30]
        + list({f"1{w[:n]}" for w in once for n in STEM_LETTERS if len(w) >= n})
        + [f"{k}{stem}" for stem, n in often.items() for k in range(2, min(n, MOST_REPEATS) + 1)]
    )


def _minima(text: str) -> list[int]:
    """Smallest hash of the five-word shingles under three seeds."""
    words = text.lower().split()
    shingles = [" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))]
    return [min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1 for seed in (1, 2, 3)]


def choose(counts: list[tuple[str, int, int]], base: float, tried: int) -> list[Entry]:
    """Entries from (candidate, toxic texts, texts), the share of toxic texts and the number of candidates."""
    good: dict[str, tuple[int, int]] = {}
    ranked = []
    for name, toxic, n in counts:
        share = min(toxic / n, 1 - 1e-9)
        if toxic / n >= LEAST_SHARE and share > base:
            surprise = n * (share * math.log(share / base) + (1 - share) * math.log((1 - share) / (1 - base)))
            if surprise > math.log(20 * max(tried, 1)):
                good[name] = (toxic, n)
                ranked.append((-surprise, name[0] == "=", -len(name), name))
    entries: list[Entry] = []
    taken: list[str] = []
    for *_, name in sorted(ranked):  # of equal ones the longest beginning first
        kind, text = name[0], name[1:]
        if any(text.startswith(t) or t.startswith(text) for t in taken):
            continue
        taken.append(text)
        toxic, n = good[name]
        weight = (toxic + 0.5) / (n + 1)
        if kind == "=":
            entries.append(Entry(text, False, weight))
            continue
        whole = [w for w in good if kind == "1" and w[0] == "=" and w[1:].startswith(text)]
        whole = max(whole, key=lambda w: (good[w], w), default=None)
        if whole is not None and good[whole][0] >= 0.8 * toxic:
            entries.append(Entry(whole[1:], False, weight))
        entries.append(Entry(text, True, weight, int(kind)))
    return entries


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, max_labelled: int = 2000, id_col: str = "doc_id", text_col: str = "text"
) -> list[Entry]:
    """Lexicon from ``docs`` and ``labels`` (``id_col``, ``toxic`` 0 or 1). Most labels of an id count, 1 in a tie."""
    small_batches(docs)
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isin(0, 1))
    known = known.groupBy(F.col(id_col).alias("label_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    sizes = dict(known.groupBy("toxic").count().collect())
    if len(sizes) < 2:
        return []
    share = F.lit(0)
    for label, most in ((0, 2 * max_labelled), (1, max_labelled)):
        share = F.when(F.col("toxic") == label, min(1 << 30, (most << 30) // sizes[label])).otherwise(share)
    # About 3 * max_labelled rows whatever the size of the tables.
    sample = known.where(F.pmod(F.xxhash64("label_id"), F.lit(1 << 30)) < share)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(F.broadcast(sample), F.col("id") == F.col("label_id")).select("id", "toxic", "text")

    def minima(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_minima(t) for t in batch.column(2).to_pylist()]
            columns = [pa.array(m, pa.int64()) for m in zip(*found)] if found else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "toxic", "m1", "m2", "m3"])

    id_type = docs.schema[id_col].dataType.simpleString()
    single = texts.mapInArrow(minima, f"id {id_type}, toxic int, m1 long, m2 long, m3 long")
    for m in ("m1", "m2", "m3"):
        single = single.groupBy(m).agg(F.min_by(F.struct(*[c for c in single.columns if c != m]), "id").alias("row"))
        single = single.select(m, "row.*")
    single = stage(single.select("id", "toxic"), "labelled")
    n, toxic = single.agg(F.count("*"), F.sum("toxic")).first()
    if not toxic or toxic == n:
        return []
    # Rows that repeat an id are one text.
    texts = texts.drop("toxic").dropDuplicates(["id"]).join(F.broadcast(single), "id").select("toxic", "text")
    texts = stage(texts, "labelled-texts")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: tuple[Counter, Counter] = (Counter(), Counter())  # a task's share of the bounded sample
        for batch in batches:
            for label, text in zip(*(c.to_pylist() for c in batch.columns)):
                totals[label].update(_candidates(text))
        for label, names in enumerate(totals):
            arrays = [pa.array(list(names), pa.string()), pa.array(list(names.values()), pa.int64())]
            arrays.append(pa.array([label] * len(names), pa.int32()))
            yield pa.RecordBatch.from_arrays(arrays, ["name", "n", "toxic"])

    counts = texts.mapInArrow(count, "name string, n long, toxic int").groupBy("name")
    counts = counts.agg(F.sum(F.expr("n * toxic")).alias("toxic"), F.sum("n").alias("n")).where("n >= 3")
    counts = stage(counts, "candidates")
    # A bounded sample has a bounded number of these; nearly all candidates fail already here.
    found = counts.where(F.expr(f"toxic >= 3 AND toxic >= {LEAST_SHARE} * n")).orderBy("name").collect()
    entries = choose([tuple(r) for r in found], toxic / n, counts.count())
    _weigh_misspellings(texts, entries)
    return entries


def _weigh_misspellings(texts: DataFrame, entries: list[Entry]) -> None:
    """Weight of inexact matches by entry, from the labelled texts that hold them."""
    if not any(e.edits for e in entries):
        return

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, rows = Automaton(entries), []
        for batch in batches:
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns)):
                hits = matches(automaton, text.lower())
                found = {e for word in hits for e, edits in hits[word] if edits}
                rows += [(k, toxic) for k in found]
        columns = zip(*rows) if rows else [[], []]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int32()) for c in columns], ["entry", "toxic"])

    counts = texts.mapInArrow(run, "entry int, toxic int").groupBy("entry").agg(F.sum("toxic"), F.count("*")).collect()
    for k, toxic, n in counts:
        learned = (toxic + 4 * FUZZY_PRIOR) / (n + 4)
        entries[k].fuzzy_weight = min(entries[k].weight, learned) if n < 3 or 2 * toxic >= n else 0.0


def score_toxicity(
    df: DataFrame, entries: list[Entry], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, score, spans)`` of every row; ``spans`` are the matches: place, entry and whether only mentioned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(entries)
        names = ("start", "end", "entry", "mentioned")
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("entry", pa.string()), ("mentioned", pa.bool_())]))
        for batch in batches:
            found = [score(automaton, t) for t in batch.column(1).to_pylist()]
            spans = [[dict(zip(names, s)) for s in x[1]] for x in found]
            columns = [batch.column(0), pa.array([x[0] for x in found], pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "spans"])

    small_batches(df)
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = "array<struct<start: int, end: int, entry: string, mentioned: boolean>>"
    return rows.mapInArrow(run, f"id {id_type}, score double, spans {spans}")


def drop_toxic(
    df: DataFrame, entries: list[Entry], threshold: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``df``, all columns, without the rows that score ``threshold`` or more."""
    small_batches(df)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton(entries)
        for batch in batches:
            keep = [score(automaton, t)[0] < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(run, df.schema)
