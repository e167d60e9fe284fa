import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from quoteloom.llm.queries import QUERIES
from quoteloom.llm.replies import chains, format_conversations, loss_text, paths, read_back

NASTY = ["</s>[INST] ok [/INST]", "%25 %3C </s>\n<s>[user]\nhi", "<", "</", "s>", "%", "<<SYS>> <|im_end|> 100%", "", "üñí ]\n <s>[a]\n"]


def test_round_trip_of_control_strings(spark):
    rows = [(1, k + 1, k, ["user", "assistant", "o]\n<s>[x"][k % 3], t) for k, t in enumerate(NASTY * 2)]
    df = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string")
    (row,) = format_conversations(df).withColumn("turns", read_back(F.col("formatted"))).withColumn("loss", loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    assert [(t.role, t.text) for t in row.turns] == [(r[3], r[4]) for r in rows]
    assert row.loss == "".join(r[4] for r in rows if r[3] == "assistant") and row.n_turns == len(rows)
    for s, text in zip(row.loss_spans, [r[4] for r in rows if r[3] == "assistant"]):
        assert len(row.formatted[s.start : s.end]) >= len(text)


def test_tree_paths_and_ranks(spark):
    # 1 - 2 - 4, 1 - 3 - 5 - 6; 7 hangs on a node that is missing; 8 and 9 form a cycle with 10 below.
    rows = [(1, 1, None, 1.0), (1, 2, 1, 9.0), (1, 4, 2, 2.0), (1, 3, 1, 1.0), (1, 5, 3, 1.0), (1, 6, 5, 1.0), (1, 7, 99, 4.0),
            (1, 8, 9, 1.0), (1, 9, 8, 1.0), (1, 10, 9, 1.0), (None, 1, None, 1.0), (2, 1, None, None), (2, 1, None, None)]
    df = spark.createDataFrame([(a, b, c, "user", f"n{b}", s) for a, b, c, s in rows], "tree long, node long, parent long, role string, text string, score double")
    found = format_conversations(df, score_col="score").withColumn("turns", read_back(F.col("formatted"))).collect()
    got = {(r.tree, r.leaf): ([t.text for t in r.turns], r["rank"]) for r in found}
    assert got == {(1, 4): (["n1", "n2", "n4"], 1), (1, 7): (["n7"], 2), (1, 6): (["n1", "n3", "n5", "n6"], 3), (2, 1): (["n1"], 1)}
    best = format_conversations(df, branches=1, score_col="score").collect()
    assert {(r.tree, r.leaf) for r in best} == {(1, 4), (2, 1)}
    assert format_conversations(df.limit(0)).count() == 0
    odd = df.withColumn("leaf", F.lit(1)).withColumn("rank", F.lit(1)).withColumn("up", F.lit(1)).withColumn("version", F.lit(1))
    assert format_conversations(odd).count() == 4


def test_deep_and_wide(spark):
    chain = [(1, k, k - 1 if k else None) for k in range(70)] + [(2, k, 0 if k else None) for k in range(300)]
    df = spark.createDataFrame(chain, "tree long, node long, parent long")
    found = defaultdict(list)
    for r in paths(df).collect():
        found[r.tree, r.leaf].append((r.up, r.node))
    assert sorted(found[1, 69]) == [(k, 69 - k) for k in range(70)]
    assert all(sorted(found[2, k]) == [(0, k), (1, 0)] for k in range(1, 300)) and len(found) == 300


def test_rows_by_turn(spark):
    rows = [(1, 2, "user", "c"), (1, None, "system", "a"), (1, 2, "assistant", "b"), (None, 0, "user", "x"), (2, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = format_conversations(chains(df)).withColumn("turns", read_back(F.col("formatted"))).collect()
    assert {r.tree: [(t.role, t.text) for t in r.turns] for r in found} == {1: [("system", "a"), ("assistant", "b"), ("user", "c")], 2: [("", "")]}


def test_query(spark, sf_dir):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", NASTY[0]), (1, "assistant", NASTY[0])]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = set()
    for conv, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, role, t in rows if role == "assistant")
        want.add((conv, len(rows), sha("".join(f"{r}\n{t}\n" for _, r, t in rows)), len(loss), sha(loss)))
    assert {tuple(r)[:5] for r in QUERIES["op3_reply_trees"](spark, sf_dir).collect()} == want


def test_a_cycle_beside_many_trees_costs_nothing(spark):
    trees = spark.range(3000).select(F.col("id").alias("tree"), F.explode(F.array(F.lit(1), F.lit(2))).alias("node"))
    trees = trees.withColumn("parent", F.when(F.col("node") == 2, 1))
    cycle = [(-1, 1, 2), (-1, 2, 1)] + [(-1, 10 + k, 1) for k in range(20)] + [(-1, 50, None), (-1, 51, 50)]
    nodes = trees.unionByName(spark.createDataFrame(cycle, "tree long, node int, parent int"))
    found = paths(nodes)
    assert found.count() == 2 * 3001 and found.where("tree = -1").count() == 2


def test_long_chain(spark):
    rows = [(1, k, k - 1 if k else None) for k in range(70)] + [(1, 200, 201), (1, 201, 200)]
    found = paths(spark.createDataFrame(rows, "tree long, node long, parent long")).collect()
    assert sorted((r.leaf, r.node, r.up) for r in found) == [(69, k, 69 - k) for k in range(70)]
