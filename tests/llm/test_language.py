import numpy as np
import pytest
from pyspark.sql import functions as F

from quoteloom.llm.language import UNKNOWN, identify_languages, letters, mixtures
from quoteloom.llm.queries import QUERIES


def test_held_out(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op2_language_mixtures"](spark, sf_dir).collect()
    assert len(found) == len(truth)
    held = [r for r in found if r.held_out]
    assert held and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_letters():
    found = letters(["Ab, c!", "", "12", "é x"])
    assert found.words.tolist() == [2, 0, 0, 2] and len(found.trigrams) == 5 and found.word_starts.tolist() == [0, 2, 3, 4]
    assert letters([""]).words.tolist() == [0]


def test_mixture_of_two():
    # 30 words that are surely of language 0, 10 surely of 1, then a text of language 2 alone.
    sure = lambda k, n: np.tile(np.where(np.arange(3) == k, 0.0, -20.0), (n, 1))
    shares, _ = mixtures(np.concatenate([sure(0, 30), sure(1, 10), sure(2, 5)]), np.array([40, 5]), 10)
    assert np.allclose(shares, [[0.75, 0.25, 0], [0, 0, 1]], atol=1e-3)


def test_mixed_text_and_edges(spark):
    en, de = "the thing with the other ring and this then ", "und schöne große Häuser auch nicht weiß über "
    train = spark.createDataFrame([(k, (en if k % 2 else de) * 5, "en" if k % 2 else "de") for k in range(20)] + [(90, None, "en"), (91, en, None), (None, de, "de")], "doc_id long, text string, lang string")
    rows = [(1, en), (2, de), (3, en * 6 + de * 3), (4, None), (5, "12 !?"), (None, de), (7, en * 20000), (7, en)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lang", F.lit("xx")).withColumn("score", F.lit(9)).withColumn("id", F.lit(0))
    got = {(r.id, r.lang) for r in identify_languages(df, train).collect()}
    assert got == {(1, "en"), (2, "de"), (3, "en"), (4, UNKNOWN), (5, UNKNOWN), (None, "de"), (7, "en")}
    (mixed,) = [r for r in identify_languages(df, train).collect() if r.id == 3]
    assert mixed.langs == ["en", "de"] and 0.5 < mixed.shares[0] < 0.8
    assert {r.lang for r in identify_languages(df, train.limit(0)).collect()} == {UNKNOWN}
    assert identify_languages(df.limit(0), train).count() == 0


def test_four_languages_are_all_kept(spark):
    parts = {
        "de": "und schöne große häuser auch nicht weiß über straße ",
        "en": "the thing with which other this then through why ",
        "es": "señor niño cuando porque llama pequeño ella quien ",
        "fr": "beaucoup français où très oiseau jour vous cœur ",
    }
    train = spark.createDataFrame([(k, parts[x] * 5, x) for k, x in enumerate(list(parts) * 5)], "doc_id long, text string, lang string")
    df = spark.createDataFrame([(1, "".join(t * 8 for t in parts.values()))], "doc_id long, text string")
    (row,) = identify_languages(df, train).collect()
    assert sorted(row.langs) == sorted(parts) and all(0.15 < x < 0.35 for x in row.shares)


def test_set_with_the_best_penalised_likelihood():
    """Against all sets of languages, each fitted by plain loops, where the loops' best set is a chain of eliminations."""
    rng = np.random.default_rng(4)
    for truth in ([1, 0, 0, 0], [0.5, 0.5, 0, 0], [0.4, 0.3, 0.3, 0], [0.25] * 4):
        of = rng.choice(4, 80, p=truth)
        logs = np.where(np.arange(4) == of[:, None], 0.0, -8.0)
        (shares,), (value,) = mixtures(logs, np.array([80]), 50)
        best = (-np.inf, None)
        for chosen in range(1, 16):
            inside = [k for k in range(4) if chosen >> k & 1]
            p = np.full(len(inside), 1 / len(inside))
            for _ in range(200):
                part = np.exp(logs[:, inside]) * p
                p = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
            total = np.log((np.exp(logs[:, inside]) * p).sum(axis=1)).sum() - 0.5 * len(inside) * np.log(81)
            best = max(best, (total, tuple(inside)))
        assert tuple(np.flatnonzero(shares > 0)) == best[1] and abs(value - best[0]) < 0.05


def test_too_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("quoteloom.llm.language.MAX_LANGUAGES", 2)
    train = spark.createDataFrame([(k, "abc", f"l{k}") for k in range(3)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 2"):
        identify_languages(train, train)
