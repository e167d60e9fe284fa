import zlib
from collections import defaultdict
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quoteloom.llm import patternpack
from quoteloom.llm.patternpack import WordEncoder, nonnegative_least_squares, pack_by_patterns, pack_lengths, patterns
from quoteloom.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, texts, reference, tokens):
    """All ids once, in whole documents unless longer than a sequence; sequences gapless. Gives their number."""
    ids = [np.array(reference(t), "<u4") for t in texts]
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        seen[r.doc_id].append((r.piece, r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for k, found in enumerate(ids):
        want = [(p, s, min(tokens, len(found) - s)) for p, s in enumerate(range(0, len(found), tokens))]
        assert sorted(seen[k]) == want
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= tokens
    return len(sequences)


def test_query_is_whole_and_dense(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    assert [d.doc_id for d in docs] == list(range(len(docs)))
    rows = QUERIES["op13_pattern_packing"](spark, sf_dir).collect()
    n = check(rows, [d.text for d in docs], reference, 4096)
    assert n <= 1.02 * -(-sum(r.length for r in rows) // 4096) + 1


def test_encoder_gives_the_ids_of_the_library(reference):
    texts = ["", " ", "Two  Words\t\n here", "it's WE'VE '' 's", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "é ́e e ́", "a b c\x1cd\x85e",
             "ΟΔΟΣ ΟΔΟΣ. İstanbul ẞ", "日本 🙂🙂 12345 a1b2", "x" * 5000, "a\x0bb\x0cc\rd", "ﬁ ǅ K"]
    codec = WordEncoder(PATH)
    for t in texts:
        assert np.frombuffer(codec.ids(t), "<u4").tolist() == reference(t)[:-1], t


def test_every_character_and_pair_of_kinds(reference):
    codec = WordEncoder(PATH)
    for c in map(chr, [*range(1, 0x400), 0x1E9E, 0x2028, 0x3000, 0x212A, 0x1F600]):
        for text in (c, f"a{c}b", f"{c}{c}1", f"x'{c}S", f"é{c}!", f"'s{c}'ll"):
            assert np.frombuffer(codec.ids(text), "<u4").tolist() == reference(text)[:-1], text


def test_cache_starts_anew(monkeypatch, reference):
    monkeypatch.setattr(patternpack, "CACHE_WORDS", 3)
    codec = WordEncoder(PATH)
    for text in ("one two three four", "five one", "two six seven"):
        assert np.frombuffer(codec.ids(text), "<u4").tolist() == reference(text)[:-1]


def test_edges(spark, frame, reference):
    texts = [None, "", "a", "word " * 3000, "b c d"]
    df = frame(texts)
    assert check(pack_by_patterns(df, PATH, tokens=512).collect(), texts, reference, 512) == 6
    assert pack_by_patterns(df.limit(0), PATH).count() == 0
    clash = df.withColumn("piece", F.lit("x")).withColumn("sequence_id", F.lit(0.5))
    check(pack_by_patterns(clash, PATH, tokens=512).collect(), texts, reference, 512)
    twice = pack_by_patterns(df.union(df), PATH, with_ids=True).collect()
    assert sum(r.length for r in twice) == 2 * sum(len(reference(t)) for t in texts)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in twice)
    named = df.withColumn("doc_id", F.concat(F.lit("n"), "doc_id"))
    assert {r.doc_id for r in pack_by_patterns(named, PATH).collect()} == {f"n{k}" for k in range(5)}
    unnamed = df.withColumn("doc_id", F.lit(None).cast("long"))
    assert {r.doc_id for r in pack_by_patterns(unnamed, PATH).collect()} == {None}


def test_several_blocks(spark, frame, reference, words, monkeypatch):
    monkeypatch.setattr(patternpack, "BLOCK", 50)
    texts = [words(k % 40) for k in range(300)]
    rows = pack_by_patterns(frame(texts), PATH, tokens=256).collect()
    lower = -(-sum(r.length for r in rows) // 256)
    assert lower <= check(rows, texts, reference, 256) <= lower + 3 * 6


def test_patterns_are_all_that_fill_a_sequence():
    steps = np.array([1, 2, 3, 5, 8, 12])
    want = {c for n in range(1, 5) for c in combinations_with_replacement(steps.tolist(), n) if sum(c) == 12}
    found = patterns(steps, 12, 4)
    assert set(found) == want and len(found) == len(want)
    assert len(patterns(np.arange(1, 65), 64, 6)) < 40_000


def test_least_squares_meets_the_optimality_conditions():
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.random((8, 30)) * (rng.random((8, 30)) < 0.4), rng.random(8) * 10
        x = nonnegative_least_squares(a, b)
        gradient = a.T @ (b - a @ x)
        assert (x >= 0).all() and gradient.max() < 1e-6 and abs(gradient[x > 0]).max(initial=0) < 1e-6


@pytest.mark.parametrize("seed", range(5))
def test_few_sequences(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(6.3, 1.1, 5000).astype(int) + 1, 4096)
    sequence, offset = pack_lengths(lengths, 4096)
    total = np.bincount(sequence, weights=lengths)
    assert total.max() <= 4096 and total.min() > 0 and len(total) <= 1.01 * -(-lengths.sum() // 4096) + 1
    assert ((offset + lengths) <= 4096).all()
    for empty in (np.zeros(0, int), np.array([4096]), np.array([1])):
        assert len(pack_lengths(empty, 4096)[0]) == len(empty)


def test_long_pieces_that_no_pattern_takes():
    lengths = np.array([3000] * 50 + [2500] * 10)
    assert len(set(pack_lengths(lengths, 4096)[0].tolist())) == 60
