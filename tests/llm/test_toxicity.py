import random

import pytest
from pyspark.sql import functions as F

from quoteloom.llm.queries import QUERIES
from quoteloom.llm.toxicity import NO_MATCH, Automaton, Entry, choose, drop_toxic, learn_lexicon, score, score_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_edit_distance():
    entries = [Entry(t, False, 0.9) for t in ("idiot", "worthless", "scum", "disgustingly", "clown")] + [Entry("lowe", True, 0.8), Entry("ach", True, 0.7, 2)]
    automaton, rng = Automaton(entries), random.Random(3)
    words = {e.text for e in entries} | {"lower", "ach", "achs", "x", ""}
    for _ in range(4000):
        word = list(rng.choice([e.text for e in entries]))
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(word))
            word[at : at + rng.randint(0, 1)] = rng.choices("abcdeilowst", k=rng.randint(0, 1))
        words.add("".join(word))
    for word in words:
        got = {k for k, _ in automaton.match(word)}
        want = {k for k, e in enumerate(entries) if (
            word.startswith(e.text) and len(word) >= len(e.text) + (e.need > 1) if e.stem else distance(word, e.text) <= e.edits)}
        assert got == want, word
        assert all(edits == (0 if entries[k].stem else distance(word, entries[k].text)) for k, edits in automaton.match(word))
        if want and len(word) >= 3:
            assert automaton.is_alive(word[:3])


def test_quotation_and_abuse():
    automaton = Automaton([Entry("idiot", False, 0.95), Entry("lowei", True, 0.95), Entry("ach", True, 0.9, 2)])
    of = lambda text: score(automaton, text)[0]
    assert of("you are an idiot") > of("what an idiot") > 0.5 > of('he called him an "idiot" there') > NO_MATCH
    assert of("what an idioot") < of("what an idiot") and score(automaton, "an idioot")[1][0][2] == "idiot"
    assert of("a loweisch thing") > 0.5 > of("a lowisch thing")
    assert of("achso") == NO_MATCH and of("achso achja") > 0.5
    assert of(None) == of("") == of("fine text") == NO_MATCH


def toxic_frames(spark, n=60):
    rng = random.Random(1)
    plain = lambda: " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(30))
    rows = [(k, plain() + (" zzwicked person" if k % 3 == 0 else " kind person")) for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(n)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_learning(spark):
    docs, labels = toxic_frames(spark)
    entries = learn_lexicon(docs, labels)
    assert {e.text for e in entries} == {"zzwicked"}
    assert learn_lexicon(docs, labels.where("toxic = 0")) == [] == learn_lexicon(docs.limit(0), labels)
    # Copies count once: many copies of one toxic text teach nothing.
    copies = spark.createDataFrame([(k, "same odd text again") for k in range(50)] + [(100 + k, f"other {k} text") for k in range(50)], "doc_id long, text string")
    marks = spark.createDataFrame([(k, 1) for k in range(50)] + [(100 + k, 0) for k in range(50)], "doc_id long, toxic int")
    assert learn_lexicon(copies, marks) == []
    assert choose([("1abc", 0, 5)], 0.5, 10) == []


def test_edges(spark, frame):
    entries = [Entry("idiot", False, 0.95)]
    rows = [(1, None), (2, ""), (None, "an idiot"), (4, "an idiot"), (4, "an idiot"), (5, "filler " * 50000 + "idiot")]
    df = frame(rows).withColumn("score", F.lit(1)).withColumn("id", F.lit(2)).withColumn("spans", F.lit(3))
    got = sorted(((r.id, r.score > 0.5) for r in score_toxicity(df, entries).collect()), key=str)
    assert got == sorted([(1, False), (2, False), (None, True), (4, True), (4, True), (5, True)], key=str)
    assert {r.doc_id for r in drop_toxic(df, entries).collect()} == {1, 2} and drop_toxic(df, entries).columns == df.columns
    assert score_toxicity(df.limit(0), entries).count() == 0
    assert {r.score for r in score_toxicity(df, []).collect()} == {NO_MATCH}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_held_out(spark, sf):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in QUERIES["op5_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in found) >= 0.95 * len(found)
    assert not any(r.predicted for r in found if not labels[r.doc_id])
