import random

from pyspark.sql import functions as F

from quoteloom.llm.decontam import contained_items
from quoteloom.llm.queries import QUERIES

ITEM = "Tom bought 12 apples and 30 pears at the market near Berlin for 4 euros before he met Anna at noon."


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_planted_cases(spark, frame):
    changed = "Jim bought 15 apples and 41 pears at the market near Munich for 6 euros before he met Lisa at noon."
    mixed = "Tom bought 12 apples and 30 pears at the market near Berlin for 4 euros before Tom bought 99 apples and 30 pears"
    texts = [
        f"Some words before. {ITEM} And some after.",
        f"{changed}",
        ITEM.upper(),
        ITEM.lower(),
        ITEM.replace(" ", "\n\t "),
        "Tom bought 12 apples and went home.",
        "No word of it here at all, but numbers 12 and 30.",
        f"{ITEM} {ITEM} {changed}",
        None,
        "",
        "x " * 40000 + ITEM,
    ]
    got = {r.id: r for r in contained_items(frame(texts), items(spark, ITEM, None, "", "12 13 14")).collect()}
    assert set(got) == {0, 1, 2, 3, 4, 7, 10} and {r.item_id for r in got.values()} == {0}
    assert got[0].n_changed == 0 and got[4].n_changed == 0 and got[1].n_changed > 3 and got[1].share > 0.9
    assert mixed  # a text whose slots contradict each other is covered in part only
    assert contained_items(frame(texts), items(spark, ITEM).limit(0)).count() == 0
    assert contained_items(frame(texts).limit(0), items(spark, ITEM)).count() == 0


def test_slots_must_agree(spark, frame):
    item = "Add 5 to 7 then take 5 from 9 and give 7 to the one that has 9 of them."
    good = "Add 1 to 2 then take 1 from 3 and give 2 to the one that has 3 of them."
    bad = "Add 1 to 2 then take 4 from 6 and give 8 to the one that has 3 of them."
    got = {r.id for r in contained_items(frame([item, good, bad]), items(spark, item)).collect()}
    assert got == {0, 1}


def test_contradiction_leaves_the_unchanged_windows(spark, frame):
    item = "Put 5 red boxes on the shelf by the old harbor gate and then carry 5 blue ones to the mill behind the church at noon."
    edited = item.replace("carry 5", "carry 6")
    got = {r.id: r for r in contained_items(frame([item, edited]), items(spark, item)).collect()}
    assert set(got) == {0, 1} and got[1].n_changed == 0 and 0.5 <= got[1].share < 1


def test_short_item_repeats_and_clashes(spark, frame):
    df = frame([(1, "Yes, alpha beta gamma it is"), (1, "Yes, alpha beta gamma it is"), (None, "alpha beta gamma"), (3, "alpha gamma beta")])
    odd = df.withColumn("w", F.lit(1)).withColumn("item_id", F.lit(2)).withColumn("pos", F.lit(3)).withColumn("id", F.lit(4))
    got = sorted(((r.id, r.item_id, r.share) for r in contained_items(odd, items(spark, "Alpha beta gamma.")).collect()), key=str)
    assert got == [(1, 0, 1.0), (None, 0, 1.0)]


def test_broadcast_and_shuffle_agree(spark, frame, words, monkeypatch):
    from quoteloom.llm import decontam

    rng = random.Random(4)
    bench = [words(rng.randint(8, 30)) for _ in range(20)]
    df = frame([f"{words(20)} {rng.choice(bench)} {words(20)}" for _ in range(40)])
    result = lambda: sorted(map(tuple, contained_items(df, items(spark, *bench)).collect()))
    first = result()
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert result() == first and len(first) == 40


def test_query_finds_all_passages(spark, sf_dir):
    flat = lambda t: " ".join((t or "").lower().split())
    docs = [(r.doc_id, flat(r.text)) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    bench = [(r.item_id, flat(r.text)) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(d, b) for b, item in bench for d, text in docs if item in text}
    assert {(r.doc_id, r.item_id) for r in QUERIES["op1_decontamination"](spark, sf_dir).collect()} == want
