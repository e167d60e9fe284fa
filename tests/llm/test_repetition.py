import random

import numpy as np
from pyspark.sql import functions as F

from quoteloom.llm.queries import QUERIES
from quoteloom.llm.repetition import longest_repeats, repetition_verdicts

BLANKS = " \t\n\x0b\x0c\r"


def split(text):
    return [w for w in "".join(" " if c in BLANKS else c for c in text).split(" ") if w]


def brute(text, min_words=8):
    text = text or ""
    words = split(text)
    n = len(words)
    lines = [x for x in text.split("\n") if split(x)]
    windows = {}
    for k in range(n - 2):
        windows.setdefault(tuple(words[k : k + 3]), []).append(k)
    repeated = {k + j for places in windows.values() if len(places) > 1 for k in places for j in range(3)}
    longest, covered = 0, set()
    for a in range(n):
        best = 0
        for b in range(n):
            k = 0
            while a != b and max(a, b) + k < n and words[a + k] == words[b + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= min_words:
            covered |= set(range(a, a + best))
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), len(covered), longest)


def test_longest_repeats():
    rng = random.Random(2)
    for _ in range(200):
        a, b = rng.randint(0, 12), rng.randint(0, 30)
        words = np.array([rng.randint(0, 2) for _ in range(a)] + [10 + rng.randint(0, 2) for _ in range(b)], dtype=np.int64)
        got = longest_repeats(words, np.array([a] * a + [a + b] * b, dtype=np.int64))
        for start, end in ((0, a), (a, a + b)):
            for i in range(start, end):
                want = 0
                for j in range(start, end):
                    k = 0
                    while i != j and max(i, j) + k < end and words[i + k] == words[j + k]:
                        k += 1
                    want = max(want, k)
                assert got[i] == want


def test_measures_against_brute_force(spark, frame, words):
    phrase = words(12)
    texts = [None, "", " \n", "a", "# * $\na b\n\na b\n a b", words(60), f"{words(40)} {phrase} {words(30)}\n{phrase} x", "a b " * 40,
             "ein wort\x0bzwei\x85drei\xa0vier " * 3, phrase + " " + phrase]
    found = {r.id: r for r in repetition_verdicts(frame(texts)).collect()}
    for k, text in enumerate(texts):
        r, want = found[k], brute(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words, r.longest_repeat) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert r.base_failed == failed and r.kept == (not failed and want[5] <= 0.3 * want[0] and want[6] <= 200)


def test_edges(spark, frame):
    rows = [(None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "w" * 300000 + " x" * 50000)]
    df = frame(rows).withColumn("n_words", F.lit(0)).withColumn("kept", F.lit("?")).withColumn("id", F.lit(5))
    assert sorted((str(r.id), r.n_words) for r in repetition_verdicts(df).collect()) == [("1", 3), ("1", 3), ("2", 50001), ("None", 3)]
    assert repetition_verdicts(df.limit(0)).count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op9_suffix_repetition"](spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(docs)
    for r in found:
        assert r.n_words == len(split(docs[r.doc_id]))
    for r in found[:12]:
        if r.n_words < 400:
            assert (r.n_repeat_words, r.covered_words, r.longest_repeat) == brute(docs[r.doc_id])[4:]
