import re

from pyspark.sql import functions as F

from quoteloom.llm.queries import QUERIES
from quoteloom.llm.urls import Rule, judge_urls

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    if url is None or "://" not in url:
        return "", "", None
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p) for _, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None


URLS = [None, "", "no scheme", "http://", "http://ORG/x", "https://a.b.Example.ORG/es/1?x=1#y", "http://example.org/en/12", "http://example.org",
        "http://example.org?/es/", "http://Ä.com/fr/", "http://com/de/", "x://y://com/de/", "http://notcom/de/", "http://a.com/de", "http://a.net/%20\n/z", "http://a.net/" + "q" * 20000]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    odd = df.withColumn("host", F.lit(1)).withColumn("score", F.lit(2)).withColumn("rule", F.lit(3)).withColumn("id", F.lit(4))
    rules = [Rule(*r) for r in RULES]
    for frame in (df, odd, df.union(df)):
        for r in judge_urls(frame, rules).collect():
            assert (r.host, r.path, r.rule) == plain(URLS[r.id])
            assert r.rule is None or r.verdict == next(v for v, h, p in RULES if h + p == r.rule)
            assert r.verdict in ("allow", "block") and 0 <= r.score <= 1
    assert judge_urls(df.limit(0), rules).count() == 0
    # Without labelled URLs of both kinds the share of blocked ones decides.
    assert {r.verdict for r in judge_urls(df, []).collect()} == {"allow"}
    assert {r.score for r in judge_urls(df, rules[1:2]).collect()} == {1.0}


def test_trees_learn_from_ruled_urls(spark):
    rows = [(k, f"http://s{k % 50}.{'com/de' if k % 2 else 'com/fr'}/{'9' * (k % 2 * 9)}{k}") for k in range(400)]
    rows += [(1000 + k, f"http://t{k}.net/en/{'9' * (k % 2 * 9)}{k}") for k in range(100)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    found = [r for r in judge_urls(df, [Rule(*r) for r in RULES]).collect() if r.rule is None]
    assert len(found) == 100 and sum((r.verdict == "block") == bool(r.id % 2) for r in found) >= 95


def test_query(spark, sf_dir):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    found = QUERIES["op6_url_filter"](spark, sf_dir).collect()
    assert len(found) == len(urls)
    assert all((r.host, r.path, r.rule) == plain(urls[r.page_id]) for r in found)
