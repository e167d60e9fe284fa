"""Quoted fields over several lines, against Python's own CSV reader, for any split size."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from quoteloom.sources.files import columns_of, field, read_csv, read_wide_csv

PIECES = ["a", "b c", '""', ",", "\n", "\n\n", "é", "1.5"]


def random_file(rng):
    lines = ["k,v,w"]
    for k in range(rng.randint(0, 40)):
        def quoted():
            return '"' + "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 6))) + '"'

        fields = [rng.choice([quoted(), "plain", 'in"ner', "", '5" disk']) for _ in range(2)]
        lines.append(",".join([f"r{k}", *fields]))
        if rng.random() < 0.1:
            lines.append("")
    return "\n".join(lines) + rng.choice(["", "\n"])


def plain(text):
    found = [r for r in csv.reader(io.StringIO(text)) if r]
    return [tuple(v or None for v in r) for r in found[1:]]


@pytest.mark.parametrize("split", ["16", "57", "1000", "128m"])
def test_any_split_size_gives_the_same_records(spark, tmp_path, split):
    rng = random.Random(3)
    texts = {f"f{k}.csv": random_file(rng) for k in range(12)}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    settings = {"spark.sql.files.maxPartitionBytes": split, "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = read_csv(spark, [str(tmp_path / n) for n in texts]).orderBy("file_name", "row_order").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    found = {name: [] for name in texts}
    for r in got:
        found[r.file_name].append(tuple(r.fields[c] for c in ("k", "v", "w")))
    assert found == {name: plain(text) for name, text in texts.items()}


def one(spark, tmp_path, text):
    path = tmp_path / "x.csv"
    path.write_text(text)
    return path, [tuple(r)[:-1] for r in read_wide_csv(spark, str(path)).orderBy("row_order").collect()]


def test_break_in_the_header_and_in_a_field(spark, tmp_path):
    path, got = one(spark, tmp_path, 'Symbol,"long\nname",n\nAAA,"two\nlines",5\nB,"x",6\n')
    assert columns_of(spark, str(path)) == ["Symbol", "long\nname", "n"]
    assert got == [("AAA", "two\nlines", "5"), ("B", "x", "6")]


def test_quote_that_is_never_closed_opens_nothing(spark, tmp_path):
    _, got = one(spark, tmp_path, 'a,b\n1,"x\ny"\n2,"open\n3,z\n4,w\n')
    assert got == [("1", "x\ny"), ("2", "open"), ("3", "z"), ("4", "w")]


def test_quotes_inside_plain_fields_are_text(spark, tmp_path):
    _, got = one(spark, tmp_path, 'a,b\n5" disk,x\n1,y"\n')
    assert got == [('5" disk', "x"), ("1", 'y"')]


def test_records_are_put_together_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,note\n1,"two\nlines"\n2,one\n')
    raw = read_csv(spark, [str(tmp_path / "a.csv")])
    assert "collect_list" not in raw._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.fields["note"] for r in raw.collect()) == ["one", "two\nlines"]


def test_fields_of_a_row_are_computed_once_for_all_uses(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,note\n1,"two\nlines"\n2,one\n')
    raw = read_csv(spark, [str(tmp_path / "a.csv")])
    used = raw.where(field("x").isNotNull() & (field("note") != "none")).select(field("x").cast("int"), field("x"), field("note"))
    assert used._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(") == 1
    assert sorted(tuple(r) for r in used.collect()) == [(1, "1", "two\nlines"), (2, "2", "one")]


def test_columns_of_files_go_to_their_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,note\n1,"two\nlines"\n')
    (tmp_path / "b.csv").write_text("x\n2\n3\n")
    (tmp_path / "c.csv").write_text("y\n4\n")

    def with_size(files):
        return files.where(F.array_contains("names", "x")).withColumn("n", F.size("names"))

    got = read_csv(spark, [str(tmp_path / f"{c}.csv") for c in "abc"], with_size)
    assert sorted((r.file_name, r.fields["x"], r.n) for r in got.collect()) == [("a.csv", "1", 2), ("b.csv", "2", 1), ("b.csv", "3", 1)]
    none = read_csv(spark, [], with_size)
    assert none.columns == got.columns and none.count() == 0
