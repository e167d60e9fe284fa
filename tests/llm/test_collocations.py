import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quoteloom.llm import collocations as module
from quoteloom.llm.collocations import collocations, numbered, phrase_counts, subtree_counts, word_hashes

SCHEMA = "doc_id long, text string, lang string"


def grams(rows, depth=4):
    counts = defaultdict(Counter)
    for text, lang in rows:
        folded = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, depth + 1):
                counts[lang or "und"].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return counts


def brute(rows, least, top=2000):
    out = []
    for lang, f in grams(rows).items():
        n = sum(c for w, c in f.items() if len(w) == 1)
        cand = {w: a for w, a in f.items() if len(w) > 1 and a >= least}
        covered = set()
        for w, a in cand.items():
            for k in range(2, len(w)):
                for i in range(len(w) - k + 1):
                    if 100 * a >= 80 * f[w[i : i + k]]:
                        covered.add(w[i : i + k])
        scored = []
        for w, a in cand.items():
            if w not in covered:
                s, _, l, r = min((2000000 * a // (f[w[:k]] + f[w[k:]]), k, f[w[:k]], f[w[k:]]) for k in range(1, len(w)))
                scored.append((-s, -a, " ".join(w).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Ünï", "日本", "a\x1cb", "x\x0by"]
    fixed = ["new york city hall", "of the", "of the", "once upon a time in", "of the people"]
    rows = []
    for k in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randint(0, 60))]
        text = "".join(p + rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n"]) for p in parts)
        rows.append((text.title() if k % 7 == 0 else text, rng.choice(["en", "en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "de"), ("!!", "fr"), ("of the " * 400, "en"), ("of " + "z" * 9000, None)]


def frame_of(spark, rows):
    return spark.createDataFrame([(k, t, lang) for k, (t, lang) in enumerate(rows)], SCHEMA)


def got(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("least, small", [(30, False), (3, False), (3, True)])
def test_against_brute_force(spark, monkeypatch, least, small):
    rows = corpus(least)
    if small:  # many groups, heavy prefixes on both levels, several ranges of the filter, small chunks
        for name, value in dict(GROUP_SUFFIXES=20, MIN_FILTER_BITS=256, MAX_FILTER_BITS=2048, CHUNK=200).items():
            monkeypatch.setattr(module, name, value)
    df = frame_of(spark, rows).repartition(5)
    want = brute(rows, least)
    assert got(collocations(df, least)) == want and len(want) > (3 if least == 30 else 50)


def test_top_and_ties(spark):
    rows = corpus(5)
    assert got(collocations(frame_of(spark, rows), 3, top=7)) == brute(rows, 3, 7)


def test_all_phrases_and_words(spark):
    rows = corpus(8)
    words, phrases = phrase_counts(frame_of(spark, rows), least=4, depth=3)
    f = grams(rows, 3)
    assert got(words) == sorted((lang, w[0], c) for lang, x in f.items() for w, c in x.items() if len(w) == 1)
    assert got(phrases) == sorted((lang, " ".join(w), len(w), c) for lang, x in f.items() for w, c in x.items() if len(w) > 1 and c >= 4)


def test_edges(spark):
    df = frame_of(spark, corpus(2))
    assert collocations(df.limit(0)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert collocations(df.limit(0)).count() == 0 and collocations(df.where("text IS NULL")).count() == 0
    clash = df.withColumn("phrase", F.lit(1)).withColumn("f", F.lit("x")).withColumn("n", F.lit(0))
    assert got(collocations(clash, 3)) == got(collocations(df, 3))


def test_hot_passage(spark):
    rows = [("the very same common passage stands here", "en")] * 3000 + corpus(4)
    assert got(collocations(frame_of(spark, rows).repartition(6), 3)) == brute(rows, 3)


def test_numbers_and_hashes(spark):
    words, ids = numbered([b"A b\tb", b"", b"c.a"])
    assert [words[k] for k in ids] == [b"a", b"b", b"b", b"\n", b"\n", b"c", b"\n", b"a"]
    want = spark.range(1).select(F.xxhash64(F.lit("en"), F.lit("größe"))).first()[0]
    assert word_hashes("en", [b"\n", b"", "größe".encode()])[2:].view(np.int64).tolist() == [want]


def test_subtree_reads_counts_from_leaves():
    phrases = ["a b", "a b c", "a b c d", "a b d", "a b d e"]
    rows = {"lang": ["en"] * 5, "phrase": phrases, "words": [2, 3, 4, 3, 4], "first": [2, 2, 2, 3, 4], "f": [1, 2, 3, 10, 100]}
    found = subtree_counts(pa.table(rows), 4, 1)
    assert sorted(found) == [("en", "a b", 2, 6), ("en", "a b c", 3, 5), ("en", "a b c d", 4, 3), ("en", "a b d", 3, 10), ("en", "a b d e", 4, 100)]
