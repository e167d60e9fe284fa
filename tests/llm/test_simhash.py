import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quoteloom.llm.components import connected_components
from quoteloom.llm.queries import QUERIES
from quoteloom.llm.simhash import BITS, allocate, fingerprint, group_bits, links, plan_probes, simhash_groups


def plain_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, radius=3):
    ids = list(prints)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "a b c", "Ä b c d e\x1cf", "x " * 5000 + "Y z"])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_query_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    prints = {d.doc_id: plain_fingerprint(d.text) for d in docs}
    want = {(i, f"{prints[i]:016x}", c) for i, c in groups_of(prints).items()}
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in QUERIES["op7_simhash_groups"](spark, sf_dir).collect()}
    assert got == want


@pytest.mark.parametrize("radius", [0, 1, 3, 5])
def test_links_are_all_found(spark, radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(64, rng.integers(1, 8), replace=False)) for b in base for _ in range(6)]
    values = sorted({int(b) for b in base} | set(near))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(s,) for s in signed], "fp long")
    got = {(r.u, r.v) for r in links(prints, radius).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (1 << 64) - 1).count("1") <= radius}
    assert got == want


def test_thresholds(spark):
    assert allocate([{-1: 0, 0: 5, 1: 9}, {-1: 0, 0: 1, 1: 2}], 0) == (2, (-1, 1))
    bits = group_bits(10, np.eye(BITS) * 5, 3)
    assert sorted(b for part in bits for b in part) == list(range(64)) and {len(p) for p in bits} == {21, 22}
    prints = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = plan_probes(prints, 3)
    assert sum(t + 1 for _, t in plan) == 4  # the thresholds of a plan add up to radius - parts + 1


def test_edges(spark, frame):
    rows = [(5, None), (4, ""), (3, "same text as that"), (9, "same text as that"), (9, "same text as that"), (None, "same text as that"), (7, "alone " * 30000)]
    got = sorted(map(tuple, simhash_groups(frame(rows)).select("id", "component").collect()), key=str)
    assert got == sorted([(5, 4), (4, 4), (3, 3), (9, 3), (9, 3), (None, 3), (7, 7)], key=str)
    assert simhash_groups(frame(rows).limit(0)).count() == 0
    odd = frame(rows).withColumn("fp", F.lit(1)).withColumn("component", F.lit(2)).withColumn("id", F.lit(3))
    assert simhash_groups(odd).count() == len(rows)


def test_components(spark):
    chain = [(k, k + 1) for k in range(60)] + [(100, 103), (103, 101), (200, 200), (None, 4), (7, None)]
    edges = spark.createDataFrame(chain + chain, "u long, v long")
    got = {(r.node, r.component) for r in connected_components(edges).collect()}
    assert got == {(k, 0) for k in range(61)} | {(100, 100), (101, 100), (103, 100), (200, 200)}
    assert connected_components(edges.limit(0)).count() == 0
