import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quoteloom.llm.packing import Packer, pack_documents
from quoteloom.llm.queries import QUERIES, packed

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [0]


def check(pieces, ids_of, tokens=1024, segments=64):
    """All ids once, sequences gapless and within limits; returns the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.array(ids_of[p.doc_id][p.start : p.start + p.length], "<u4")
        assert len(ids) == p.length and zlib.crc32(ids.tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids_of[p.doc_id])
        by_doc[p.doc_id].append((p.start, p.length))
        by_sequence[p.sequence_id].append(p)
    for doc, spans in by_doc.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == len(ids_of[doc])
    assert set(by_doc) == set(ids_of)
    padding = 0
    for members in by_sequence.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= tokens and len(members) <= segments
        assert members[0].padded_length == (at if at & (at - 1) == 0 else tokens)
        padding += members[0].padded_length - at
    return padding


def test_query_round_trip(spark, sf_dir, reference):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert check(QUERIES["op4_vector_packing"](spark, sf_dir).collect(), {d.doc_id: reference(d.text) for d in docs}) == 0


def test_edges(spark, frame, reference):
    texts = [None, "", " ", "a", "  two  blanks\n\n\there ", "x " * 3000, "naïve café no  end", "<|endoftext|> is text", "퟿ 日本 🙂🙂"]
    df = frame(texts)
    assert check(pack_documents(df, RANKS).collect(), dict(enumerate(map(reference, texts)))) == 0
    assert pack_documents(df.limit(0), RANKS).count() == 0
    clash = df.withColumn("start", df.doc_id).withColumn("ids", df.doc_id)
    assert pack_documents(clash, RANKS).count() == pack_documents(df, RANKS).count()
    twice = pack_documents(df.union(df), RANKS).collect()
    assert sum(p.length for p in twice) == 2 * sum(len(reference(t)) for t in texts)


def test_segment_and_loss_limits():
    packer = Packer(0, 64, 3, 40, False)
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 200, 300).tolist()
    heads = [int(rng.integers(0, s + 1)) for s in sizes]
    for doc, (size, head) in enumerate(zip(sizes, heads)):
        packer.add(doc, np.arange(size, dtype="<u4"), head)
    packer.fill(0)
    sequences = defaultdict(list)
    for doc_id, start, length, _, _, sequence, _, loss, _ in packer.rows:
        assert loss == max(0, start + length - max(start, heads[doc_id]))
        sequences[sequence].append((length, loss))
    assert sum(n for s in sequences.values() for n, _ in s) == sum(sizes)
    for members in sequences.values():
        assert len(members) <= 3 and sum(n for n, _ in members) <= 64 and sum(x for _, x in members) <= 40


def test_prompt_bears_no_loss(spark, reference):
    df = spark.createDataFrame([(1, "Question one?", " Answer.")], "doc_id long, q string, text string")
    (row,) = [r for r in pack_documents(df, RANKS, prompt_col="q", with_ids=True).collect() if r.start == 0][:1]
    pieces = pack_documents(df, RANKS, prompt_col="q").collect()
    assert sum(p.loss_tokens for p in pieces) == len(reference(" Answer."))
    assert row.ids is not None


def test_added_tokens_are_those_of_the_tokenizer(spark, frame):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, mark * 2, f"{mark} x", f"x{mark}y  z\n{mark}", "<|endoftext| >", f"<{mark}>", "plain text", "", None]
    ids = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert ids[0] == [64, 220, 50256, 275, 0]
    assert check(packed(frame(texts), with_ids=False).collect(), ids) == 0
    pieces = packed(frame(texts)).orderBy("doc_id", "start").collect()
    for k, want in ids.items():
        assert [i for p in pieces if p.doc_id == k for i in np.frombuffer(p.ids, "<u4")] == want
