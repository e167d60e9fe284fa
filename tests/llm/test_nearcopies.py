import random

import pytest
from pyspark.sql import functions as F

from quoteloom.llm import nearcopies
from quoteloom.llm.nearcopies import near_copies, prefix_length
from quoteloom.llm.queries import clean_of_near_copies


def plain_set(text):
    words = (text or "").lower().split()
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """Smallest id of the component of each id, by comparing all pairs."""
    sets = {i: plain_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def edited(rng, text, n):
    words = text.split()
    for k in rng.sample(range(len(words)), n):
        words[k] = f"new{rng.randint(0, 10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("rounds", [0, 2])
def test_against_brute_force(spark, frame, words, monkeypatch, rounds):
    monkeypatch.setattr(nearcopies, "ROUNDS", rounds)
    rng = random.Random(rounds)
    texts = [words(rng.randint(1, 300)) for _ in range(40)]
    passage = words(60)
    texts += [edited(rng, t, min(len(t.split()), n)) for t in texts[:30] for n in (1, 2, 4, 6)]
    texts += [f"{words(20)} {passage} {words(20)}" for _ in range(20)] + [f"{words(rng.randint(1, 9))} {passage}" for _ in range(20)]
    chain = words(200).split()
    texts += [" ".join(chain[:n]) for n in range(30, 200, 5)] + [None, "", " \n", "a b", "A  b", "a b c"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = {r.id: r.component for r in near_copies(frame(rows)).collect()}
    want = brute(rows)
    assert got == want and len(set(want.values())) < len(want)


def test_without_common_shingles_the_result_is_the_same(spark, frame, words, monkeypatch):
    rng = random.Random(3)
    base = words(80)
    rows = list(enumerate([edited(rng, base, rng.randint(0, 3)) for _ in range(40)]))
    monkeypatch.setattr(nearcopies, "SAMPLE_DOCS", 0)
    assert {r.id: r.component for r in near_copies(frame(rows)).collect()} == brute(rows)


def test_stage_finds_copies_that_differ_in_several_words(spark, frame, words):
    base = words(300)
    parts = base.split()
    for k in (20, 90, 160, 230):
        parts[k] = f"other{k}"
    rows = [(4, base), (7, " ".join(parts)), (9, words(300)), (None, base)]
    assert sorted(str(r.doc_id) for r in clean_of_near_copies(frame(rows)).collect()) == ["4", "9", "None"]


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_stage_on_given_documents(spark, name):
    docs = spark.read.parquet(f"/root/testdata/{name}/documents.parquet").where(F.length("text") < 4000)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = {r.doc_id for r in clean_of_near_copies(docs).collect()}
    assert kept == {i for i, c in brute(rows).items() if i == c}


def test_prefix_length():
    for n in range(200):
        shared = next(k for k in range(n + 1) if 100 * k >= 80 * n)  # a similar set holds at least so many
        assert prefix_length(n, 80) == (n - shared + 1 if n else 0)


def test_simhash_groups_go_first_and_change_no_result(spark, frame, words, monkeypatch):
    rng = random.Random(11)
    texts = [words(150) for _ in range(12)]
    texts += [edited(rng, t, n) for t in texts for n in (1, 1, 4)] + ["", None]
    rows = list(enumerate(texts))
    want = brute(rows)
    asked = []
    real = nearcopies.near_copies
    monkeypatch.setattr(nearcopies, "near_copies", lambda df, **kw: asked.append(kw["grouped"]) or real(df, **kw))
    kept = {r.doc_id for r in clean_of_near_copies(frame(rows)).collect()}
    assert kept == {i for i, c in want.items() if i == c}
    (given,) = asked
    assert 0 < given.where("id <> component").count() < len(want) - len(kept)  # SimHash alone misses some
    wrong = spark.createDataFrame([(i, 0) for i, _ in rows], "id long, component long")
    for grouped in (given, wrong, wrong.limit(0)):
        assert {r.id: r.component for r in real(frame(rows), grouped=grouped).collect()} == want


def test_marks_leave_only_pairs_that_may_be_similar(spark, frame, words, monkeypatch):
    rng = random.Random(5)
    texts = [words(rng.randint(1, 400)) for _ in range(30)]
    texts += [edited(rng, t, min(len(t.split()), n)) for t in texts for n in (1, 5, 9, 12)]
    sets = [nearcopies.shingles(t) for t in texts]
    marked = spark.createDataFrame([(k, len(s), nearcopies.marks(s).tolist()) for k, s in enumerate(sets)], "node long, n long, marks array<long>")
    both = [(a, b) for a in range(len(sets)) for b in range(a)]
    pairs = spark.createDataFrame(both, "u long, v long")
    kept = {tuple(r) for r in nearcopies.possible(pairs, marked, 80).collect()}
    alike = {(a, b) for a, b in both if 5 * len(set(sets[a]) & set(sets[b])) >= 4 * len(set(sets[a]) | set(sets[b]))}
    assert alike <= kept and 0 < len(alike) and len(kept) < len(both) / 20


def test_sets_are_made_for_possible_pairs_only(spark, frame, words, monkeypatch):
    passage = words(60)
    rows = [(k, f"{words(150)} {passage} {words(150)}") for k in range(30)]
    rows += [(30 + k, edited(random.Random(k), rows[k][1], 2)) for k in range(3)]
    asked = []
    real = nearcopies._sets
    monkeypatch.setattr(nearcopies, "_sets", lambda rows, wanted, size: asked.append(wanted.count()) or real(rows, wanted, size))
    monkeypatch.setattr(nearcopies, "SAMPLE_DOCS", 0)  # so that the passage is in the prefixes of many texts
    assert {r.id: r.component for r in near_copies(frame(rows)).collect()} == brute(rows)
    assert 0 < sum(asked) <= 12


def test_texts_of_one_id_link_their_copies(spark, frame, words):
    a, b, c, d = (words(80) for _ in range(4))
    rows = [(2, b), (3, a), (5, a), (5, b), (7, c), (7, "x y"), (8, d), (9, edited(random.Random(2), c, 1))]
    want = {2: 2, 3: 2, 5: 2, 7: 7, 8: 8, 9: 7}
    assert {tuple(r) for r in near_copies(frame(rows)).collect()} == set(want.items())
    assert sorted(r.doc_id for r in clean_of_near_copies(frame(rows)).collect()) == [2, 7, 7, 8]
    assert {tuple(r) for r in near_copies(frame([(1, a), (1, b), (1, "")])).collect()} == {(1, 1)}
