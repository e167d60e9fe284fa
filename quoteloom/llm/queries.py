"""Named queries over the given tables: one for each operator, with its parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.llm.common import documents, fold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def named(name: str, sql: str | None = None):
    def add(build):
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


@named("op4_vector_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir), with_ids=False)


LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, line, pos,
           translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), repeats AS (
    SELECT key, min(doc_id) AS first_id FROM keyed
    WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
    SELECT k.doc_id, k.line, k.pos, (r.key IS NULL OR k.doc_id = r.first_id) AS stays
    FROM keyed k LEFT JOIN repeats r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@named("op10_line_dedup", LINES_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.linededup import dedup_lines

    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = dedup_lines(docs, counts=("n_lines", "n_dropped"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@named("op7_simhash_groups")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.simhash import simhash_groups

    groups = simhash_groups(documents(spark, sf_dir))
    return groups.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@named("op9_suffix_repetition")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.repetition import repetition_verdicts

    return repetition_verdicts(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@named("op2_language_mixtures")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.language import identify_languages

    docs = documents(spark, sf_dir)
    found = identify_languages(docs.select("doc_id", "text"), docs.where(fold() != 0).select("doc_id", "text", "lang"))
    held_out = F.coalesce(fold("id") == 0, F.lit(False))
    return found.select(
        F.col("id").alias("doc_id"), held_out.alias("held_out"), F.col("lang").alias("lang_pred"), "score", "langs", "shares"
    )


@named("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.toxicity import learn_lexicon, score_toxicity

    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold() != 0).select("doc_id", "toxic")
    found = score_toxicity(docs, learn_lexicon(docs, labels))
    return found.select(
        F.col("id").alias("doc_id"),
        F.coalesce(fold("id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "spans",
    )


@named("op1_decontamination")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.decontam import contained_items

    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = contained_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.withColumnRenamed("id", "doc_id")


@named("op6_url_filter")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.urls import Rule, judge_urls

    rules = [
        Rule("allow", "org"),
        Rule("block", "example.org", "/es/"),
        Rule("block", "example.org", "/en/1"),
        Rule("allow", "com", "/fr/"),
        Rule("block", "com", "/de/"),
    ]
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, rules).withColumnRenamed("id", "page_id")


CHAT_SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text)
        + 2 * (length(text) - length(replace(text, '%', '')))
        + 2 * (length(text) - length(replace(text, '<s>', '12')))
        + 2 * (length(text) - length(replace(text, '</s>', '123')))
        + 2 * (length(text) - length(replace(text, '[INST]', '12345')))
        + 2 * (length(text) - length(replace(text, '[/INST]', '123456')))
        + 2 * (length(text) - length(replace(text, '<<SYS>>', '123456')))
        + 2 * (length(text) - length(replace(text, '<</SYS>>', '1234567')))
        + 2 * (length(text) - length(replace(text, '<|', '1'))) AS written
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length(role) + written + 11)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@named("op3_reply_trees", CHAT_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.replies import chains, format_conversations, loss_text, read_back

    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(control).alias("text"),
    )
    found = format_conversations(chains(rows.unionByName(added)))
    turns = F.transform(read_back(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    return found.select(
        F.col("tree").alias("conv_id"),
        "n_turns",
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@named("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.licenses import scan_licenses

    return scan_licenses(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


@named("op13_pattern_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quoteloom.llm.patternpack import pack_by_patterns

    return pack_by_patterns(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


PHRASES_SQL = r"""
WITH pieces AS (
    SELECT lang, row_number() OVER () AS piece_id, piece FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents)
), words AS (
    SELECT lang, piece_id, unnest(regexp_extract_all(piece, '[^\x20\x09]+')) AS w,
           generate_subscripts(regexp_extract_all(piece, '[^\x20\x09]+'), 1) AS pos
    FROM pieces
), grams AS (
    SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4
    FROM words WINDOW p AS (PARTITION BY piece_id ORDER BY pos)
), f AS (
    SELECT lang, w1 AS phrase, 1 AS k, count(*) AS f FROM grams GROUP BY ALL
    UNION ALL
    SELECT lang, w1 || ' ' || w2, 2, count(*) FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, count(*) FROM grams WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 30
    UNION ALL
    SELECT lang, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, 4, count(*) FROM grams WHERE w4 IS NOT NULL
    GROUP BY ALL HAVING count(*) >= 30
), totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
    SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS lhs, array_to_string(w[c + 1:k], ' ') AS rhs
    FROM cand, (SELECT unnest([1, 2, 3]) AS c) WHERE c < k
), scored AS (
    SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = lhs JOIN f y ON y.lang = cuts.lang AND y.phrase = rhs
), weakest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS nth FROM scored) WHERE nth = 1
), inner_phrases AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS over_a
    FROM cand, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m)
    WHERE m < k AND i + m - 1 <= k GROUP BY ALL
), ranked AS (
    SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank, w.phrase, a, l, r, score
    FROM weakest w LEFT JOIN inner_phrases i ON i.lang = w.lang AND i.phrase = w.phrase
    WHERE over_a IS NULL OR 100 * over_a < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@named("op11_collocations", PHRASES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.collocations import collocations

    return collocations(documents(spark, sf_dir))


SEARCH_SQL = r"""
WITH folded AS (
    SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), terms AS (
    SELECT doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM folded
), asked AS (
    SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), items AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL
), sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), corpus AS (SELECT count(*) AS docs, sum(n)::BIGINT AS len FROM sizes
), found AS (
    SELECT doc_id, term, count(*) AS tf FROM terms WHERE term IN (SELECT term FROM items) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM found, corpus GROUP BY term
), scores AS (
    SELECT item_id, doc_id,
           sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // len))))::BIGINT AS score
    FROM items JOIN found USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), corpus
    GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@named("op12_ranked_search", SEARCH_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quoteloom.llm.balltree import ranked_search

    found = ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("query_id").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


# What the stages of corpus_pipeline.py do with the operators: their decisions, on rows of documents.


def clean_of_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Without the documents that score 0.5 or more; learned from labelled documents that are not held out."""
    from quoteloom.llm.toxicity import drop_toxic, learn_lexicon

    known = labels.where(fold() != 0).select("doc_id", "toxic")
    return drop_toxic(docs, learn_lexicon(docs.select("doc_id", "text"), known))


def clean_of_repeated_lines(docs: DataFrame) -> DataFrame:
    """Lines that repeat stay in the document with the smallest id; ``n_chars`` follows the text."""
    from quoteloom.llm.linededup import dedup_lines

    kept = dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return kept
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def clean_of_near_copies(docs: DataFrame) -> DataFrame:
    """The document with the smallest id of each group; documents without a word are one group, those without an id stay.

    Groups are linked by a Jaccard similarity of 0.8 or more of their five-word shingles: SimHash groups are looked at
    first, a prefix filter finds the pairs that differ in more than a few bits.
    """
    from quoteloom.llm.common import fresh
    from quoteloom.llm.nearcopies import near_copies
    from quoteloom.llm.simhash import simhash_groups
    from quoteloom.session import stage

    (name,) = fresh(docs, "copy_id")
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    prints = stage(simhash_groups(texts).select("id", "component"), "simhash-groups")
    groups = near_copies(texts, grouped=prints)
    copies = stage(groups.where("id <> component").select(F.col("id").alias(name)), "copies")
    return docs.join(copies, F.col("doc_id") == F.col(name), "left_anti")


def clean_of_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Without the documents that contain an item of the benchmark."""
    from quoteloom.llm.common import fresh
    from quoteloom.llm.decontam import contained_items
    from quoteloom.session import stage

    (name,) = fresh(docs, "leak_id")
    found = contained_items(docs.select("doc_id", "text"), benchmark)
    leaks = stage(found.where("id IS NOT NULL").select(F.col("id").alias(name)).distinct(), "leaks")
    return docs.join(leaks, F.col("doc_id") == F.col(name), "left_anti")


def packed(docs: DataFrame, with_ids: bool = True) -> DataFrame:
    """One row per piece of the sequences of 1024 tokens, with its token ids: those of ``byte_bpe_50k.json``."""
    import public_tokenizers

    from quoteloom.llm.packing import added_tokens, pack_documents

    ranks, added = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
    return pack_documents(docs, ranks, with_ids=with_ids, added=added_tokens(added))
