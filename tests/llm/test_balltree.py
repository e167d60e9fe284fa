import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quoteloom.llm import balltree
from quoteloom.llm.balltree import BallTree, Best, ranked_search, terms

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain(text):
    return PATTERN.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, top=10):
    split = [(i, Counter(plain(t))) for i, t in docs]
    split = [(i, c) for i, c in split if c]
    n_docs, length = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in split:
            m = 25 + (75 * sum(c.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in plain(text)
                if t in c
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "id", "score").collect()), key=str)


ODD = [None, "", "...", "Ünï-code ÜNÏ 日本", "a\x00b c_d e`f", "The THE the", "long " * 5000]


def corpus(n, seed):
    rng = random.Random(seed)
    vocabulary = ["w%d" % int(rng.paretovariate(0.7)) for _ in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(n)]
    texts += [texts[0]] * 30 + ODD
    docs = list(enumerate(texts))
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(1, 20)))) for k in range(15)]
    return docs, items + [(90, texts[0]), (91, "the Ünï 日本 b long"), (92, None), (93, "unknownword"), (94, "!")]


@pytest.mark.parametrize("leaf, block", [(2, 64), (32, 8192)])
def test_against_brute_force(spark, frame, monkeypatch, leaf, block):
    monkeypatch.setattr(balltree, "BLOCK", block)
    monkeypatch.setattr(BallTree.__init__, "__defaults__", (leaf,))
    docs, items = corpus(300, leaf)
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked_search(frame(docs).repartition(3), queries)) == brute(docs, items)


def test_query_blocks_and_ties(spark, frame, monkeypatch):
    monkeypatch.setattr(balltree, "QUERIES", 4)
    monkeypatch.setattr(balltree, "VOCABULARY", 30)
    docs, items = corpus(60, 7)
    queries = spark.createDataFrame(items + items[:2], "item_id long, text string")
    assert got(ranked_search(frame(docs), queries, top=5)) == brute(docs, items, 5)


def test_edges(spark, frame):
    docs = frame([(None, "one two"), (1, "one"), (1, "one"), (2, "two")])
    queries = spark.createDataFrame([(5, "One two"), (None, "one")], "item_id long, text string")
    want = brute([(None, "one two"), (1, "one"), (1, "one"), (2, "two")], [(5, "One two"), (None, "one")])
    assert got(ranked_search(docs, queries)) == want and len(want) == 5
    assert ranked_search(docs.limit(0), queries).count() == 0
    assert ranked_search(docs, queries.limit(0)).columns == ["query_id", "rank", "id", "score"]
    clash = docs.withColumn("id", F.lit("x")).withColumn("n", F.lit(1)).withColumn("score", F.lit(2))
    assert got(ranked_search(clash, queries.withColumn("query", F.lit(0)))) == want
    named = frame([(1, "one")]).withColumn("doc_id", F.lit("first"))
    assert got(ranked_search(named, queries))[0][2] == "first"


def test_terms_are_those_of_the_pattern():
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice([chr(rng.randrange(0, 300)), "Aa", " ", "ß"]) for _ in range(40))
        assert [t.decode() for t in terms(text)] == plain(text)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(k % 5 * 40, k % 5 * 40 + 40, 12)) for k in range(600)]
    starts = np.cumsum([0, *map(len, rows)])[:-1]
    columns, values = np.concatenate(rows), rng.integers(1, 3 * 10**10, sum(map(len, rows)))
    tree = BallTree(starts, columns, values, 200, leaf=4)
    full = np.zeros((600, 200), dtype=object)
    for k, row in enumerate(rows):
        full[k, row] = [int(v) for v in values[starts[k] : starts[k] + len(row)]]
    assert sorted(tree.order.tolist()) == list(range(600))
    for q in range(20):
        at = np.unique(rng.integers(q % 5 * 40, q % 5 * 40 + 40, 15))
        counts = rng.integers(1, 4, len(at)).astype(float)
        exact = full[:, at] @ counts.astype(int).astype(object)
        bounds = tree.bounds(at, counts)
        for node in range(len(tree.first)):
            assert max(exact[tree.order[tree.first[node] : tree.end[node]]]) <= bounds[node]
        best, dense = Best(5), np.zeros(200, dtype=np.int64)
        dense[at] = counts.astype(np.int64)
        best.ids = list(range(600))
        tree.search(at, counts, dense, best)
        assert [(-s, i) for s, i in best.kept] == sorted(((s, i) for i, s in enumerate(exact) if s > 0), key=lambda x: (-x[0], x[1]))[:5]
    assert tree.scored < 20 * 600 * 0.6
