"""URL filter: rules on host and path, and gradient-boosted trees on lexical features where no rule fits.

The URLs that a rule fits are the labelled ones. Trees learn from about ``max_labelled`` of them (those whose hashed
URL falls below a share of their count) on features of the whole URL: lengths, path depth, digit ratio, character
entropy, parameter counts, marks, and how often each host ending and file ending is blocked among all labelled URLs.
Host and file endings that no labelled URL has take the overall share. Everything is DataFrame operations and
Spark's own trees; only tables of endings are joined.

Defined results: a NULL URL or one without ``://`` has an empty host and path, fits no rule, and is scored like any
other (a NULL one like an empty text); when labelled URLs of one verdict or none exist, the score is the share of
blocked ones (0 if there are none); repeated rows are judged each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.session import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """Fits URLs on ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """Lower-cased (A-Z) text from the first ``://`` to ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Text from behind the host to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Text of the longest rule that fits, NULL if none does; of equally long ones blocking comes first."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        own = (host == rule.host) | host.endswith("." + rule.host)
        out = F.when(own & path.startswith(rule.path), F.lit(rule.text)).otherwise(out)
    return out


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.when(n > 0, F.aggregate(letters, F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))).otherwise(0.0)


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(text, r"[^0-9]", ""))
    return {
        "f_length": F.length(text),
        "f_host": F.length(host),
        "f_path": F.length(path),
        "f_query": F.length(query),
        "f_depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
        "f_labels": _count(host, ".") + 1,
        "f_digits": digits / F.greatest(F.length(text), F.lit(1)),
        "f_entropy": _entropy(text),
        "f_params": F.when(query == "", 0).otherwise(_count(query, "&") + 1),
        "f_hyphens": _count(text, "-"),
        "f_secure": text.startswith("https:").cast("int"),
        "f_fragment": text.contains("#").cast("int"),
        "f_slash": path.endswith("/").cast("int"),
    }


def _endings(host: Column, path: Column) -> dict[str, Column]:
    return {
        "top": F.substring_index(host, ".", -1),
        "site": F.substring_index(host, ".", -2),
        "file": F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]{1,6})$", 1)),
    }


def judge_urls(
    df: DataFrame,
    rules: list[Rule],
    max_labelled: int = 20_000,
    trees: int = 12,
    depth: int = 3,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``(id, host, path, rule, verdict, score)`` of every row; ``score`` is the trees' chance of ``block``."""
    verdicts = {r.text: r.verdict for r in rules}
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = F.lit(None).cast("string")
    for text, verdict in verdicts.items():
        ruled = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(ruled)
    host, path = F.col("host"), F.col("path")
    features = lexical_features(F.col("url"), host, path)
    rows = rows.select("id", "url", "host", "path", "rule", ruled.alias("ruled"), *[c.cast("double").alias(n) for n, c in features.items()])
    rows = stage(rows.select("*", *[c.alias(n) for n, c in _endings(host, path).items()]), "urls")

    label = (F.col("ruled") == "block").cast("double").alias("label")
    labelled = rows.where("ruled IS NOT NULL")
    n, blocked = labelled.agg(F.count("*"), F.sum(label)).first()
    share = blocked / n if n else 0.0
    if not 0 < share < 1:
        return _verdicts(rows.withColumn("score", F.lit(float(share))))
    names = list(features)
    for ending in ("top", "site", "file"):
        # Blocked share by ending, drawn to the overall share as if 20 more labelled URLs had it.
        rates = labelled.groupBy(ending).agg(((F.sum(label) + 20 * share) / (F.count("*") + 20)).alias(f"f_{ending}"))
        rows = rows.join(stage(rates, "rates"), ending, "left").fillna(share, [f"f_{ending}"])
        names.append(f"f_{ending}")
    labelled = rows.where("ruled IS NOT NULL").select("url", label, *names)
    part = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < min(1 << 30, (max_labelled << 30) // n)
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    sample = assembler.transform(labelled.where(part)).select("label", "features")
    if sample.select(F.countDistinct("label")).first()[0] < 2:
        return _verdicts(rows.withColumn("score", F.lit(float(share))))
    booster = GBTClassifier(labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7)
    scored = booster.fit(sample).transform(assembler.transform(rows))
    return _verdicts(scored.withColumn("score", vector_to_array("probability")[1]))


def _verdicts(scored: DataFrame) -> DataFrame:
    judged = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select("id", "host", "path", "rule", F.coalesce("ruled", judged).alias("verdict"), "score")
