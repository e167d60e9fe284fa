import random

from pyspark.sql import functions as F

from quoteloom.llm.licenses import NOTICES, scan_licenses, shingles_of, window_size, words_of
from quoteloom.llm.queries import QUERIES


def test_window_sizes():
    assert [window_size(n) for n in (1, 5, 6, 9, 10, 17, 18)] == [8, 8, 16, 16, 32, 32, 64]


def test_planted_notices(spark, frame, words):
    rng = random.Random(9)
    texts, want = [], set()
    for name, notices in NOTICES.items():
        for k, notice in enumerate(notices):
            for shift in range(3):
                want.add((len(texts), name, k))
                texts.append(f"{words(rng.randint(0, 70))} {notice.upper() if shift == 1 else notice}\n{words(rng.randint(0, 70))}")
    clean = len(texts)
    texts += [words(300) for _ in range(20)] + ["Released under the", "MIT License.", None, "", "w " * 60000 + NOTICES["MIT"][0]]
    want.add((len(texts) - 1, "MIT", 0))
    got = {(r.id, r.license, r.notice) for r in scan_licenses(frame(texts)).collect()}
    assert got >= want and {i for i, _, _ in got} == {i for i, _, _ in want} and clean not in {i for i, _, _ in got}


def test_edits_and_containment(spark, frame):
    words = words_of(NOTICES["GPL-3.0"][1])
    rng = random.Random(2)
    rows = []
    for k in range(40):
        w = list(words)
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "changed"
        rows.append(" ".join(["before"] * k + w + ["after"] * 40))
    found = {r.id: r.containment for r in scan_licenses(frame(rows), {"G": [NOTICES["GPL-3.0"][1]]}).collect()}
    whole = shingles_of(words, 5)
    for k, text in enumerate(rows):
        share = len(whole & shingles_of(words_of(text), 5)) / len(whole)
        assert (k in found) == (share >= 0.8)


def test_edges(spark, frame):
    rows = [(None, "Released under the MIT License."), (1, "Released under the MIT License. x"), (1, "Released under the MIT License. x")]
    df = frame(rows).withColumn("license", F.lit("z")).withColumn("id", F.lit(0)).withColumn("containment", F.lit(1))
    got = sorted(((r.id, r.license, r.first_word, r.containment) for r in scan_licenses(df).collect()), key=str)
    assert got == sorted([(1, "MIT", 0, 1.0), (1, "MIT", 0, 1.0), (None, "MIT", 0, 1.0)], key=str)
    assert scan_licenses(df.limit(0)).count() == 0 and scan_licenses(df, {}).count() == 0 and scan_licenses(df, {"x": ["..."]}).count() == 0


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    want = {(d.doc_id, n, k) for d in docs for n, ts in NOTICES.items() for k, t in enumerate(ts) if t.lower() in d.text.lower()}
    assert {(r.doc_id, r.license, r.notice) for r in QUERIES["op8_license_scan"](spark, sf_dir).collect()} == want
