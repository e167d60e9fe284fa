"""Benchmark decontamination by templates, with DataFrame operations only.

A template replaces numbers, quantities, units behind a number and names (words inside a sentence with a capital
before a small letter) by typed placeholders and lower-cases the rest. Each window of ``window`` words of an item's
template is found in a text by a hash join on its anchor, the window's word that is rarest in the benchmark; the whole
template window is then compared. Matches of an item that lie at one distance from their places in the item form an
alignment. The values that its placeholders take in text and item must correspond one to one, type by type; so a
question that got other numbers or names is found, and a chance mixture is not; where they contradict each other, only
windows whose values are all the item's own count. An item counts as contained when
consistent alignments cover at least ``min_share`` of its words.

Only words that are some window's anchor, beside the right neighbours, leave the scan. The window table is broadcast when it has at most
``BROADCAST_WINDOWS`` rows (about 30 MB); a larger one is joined by shuffle. Every further group is bounded by the
length of an item.

Defined results: NULL or blank texts and items match nothing, nor does an item without a plain word; an item shorter
than a window is one window; rows that repeat an id are one text; rows without an id form one group with a NULL
id; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quoteloom.session import stage

BROADCAST_WINDOWS = 200_000
# Marks around words, ends of sentences, units.
MARKS = ".,;:!?\"'()[]{}<>«»„“”‘’…*_`|"
SENTENCE_END = r"[.!?:…][\"')\]»”’]*$"
NUMBER = r"^[-+$€£]?[0-9][0-9.,:/]*%?$"
QUANTITY = r"^[-+]?[0-9][0-9.,]*[a-z°µ%²³]{1,5}$"
CAPITALISED = r"^\p{Lu}[\p{Ll}'’-]"
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb oz ml cl dl l s sec min h hr hrs hz khz mhz ghz w kw kwh v a j kj pa kpa "
    "bar k c f kb mb gb tb usd eur gbp dollars dollar euros euro cents percent meters meter metres metre miles mile "
    "hours hour minutes minute seconds second days day weeks week months month years year grams gram kilograms "
    "kilometers kilometres liters litres pounds inches feet degrees"
).split()


def words_of(text: Column) -> Column:
    """Words of a text behind a first, made-up one that ends a sentence."""
    return F.split(F.concat(F.lit(". "), F.trim(F.regexp_replace(text, r"^\s+", ""))), r"\s+")


def core(word: Column) -> Column:
    """The word without marks around it; taking marks off is slow, so a word with letters at both ends is left alone."""
    first, last = F.ascii(word), F.ascii(F.substring(word, -1, 1))
    letter = lambda c: c.between(97, 122) | c.between(65, 90) | c.between(192, 591)
    return F.when(letter(first) & letter(last), word).otherwise(F.btrim(word, F.lit(MARKS)))


def template_word(before: Column, word: Column) -> Column:
    """The placeholder that stands for a word, or the word in lower case."""
    bare = core(word)
    number = bare.rlike(NUMBER)
    named = bare.rlike(CAPITALISED) & ~before.rlike(SENTENCE_END)
    return (
        F.when(number, F.lit("<number>"))
        .when(F.lower(bare).rlike(QUANTITY), F.lit("<quantity>"))
        .when(F.lower(bare).isin(UNITS) & core(before).rlike(NUMBER), F.lit("<unit>"))
        .when(named, F.lit("<name>"))
        .otherwise(F.lower(bare))
    )


def _template(words: Column) -> Column:
    """Template words of all but the first of ``words``."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: template_word(F.get(words, k - 1), F.get(words, k)))


def is_slot(word: Column) -> Column:
    return word.isin("<number>", "<quantity>", "<unit>", "<name>")


def template_windows(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> DataFrame:
    """One row per window of an item: anchor, its place in the window, its plain neighbours, the template, the words."""
    items = benchmark.where(F.length(F.trim(text_col)) > 0).select(F.col(item_col).alias("item_id"), words_of(F.col(text_col)).alias("w"))
    items = items.where("size(w) > 1").select(
        "item_id", _template(F.col("w")).alias("t"), F.transform(F.slice("w", 2, F.size("w")), core).alias("plain")
    )
    items = items.dropDuplicates(["item_id", "t", "plain"])
    each = items.select("item_id", F.explode("t").alias("word")).groupBy("word").agg(F.count("*").alias("often"))
    n = F.size("t")
    length = F.least(F.lit(window), n)
    starts = F.explode(F.sequence(F.lit(0), n - length)).alias("item_pos")
    windows = items.select("item_id", n.alias("n_words"), length.alias("length"), starts, "t", "plain")
    windows = windows.withColumn("t", F.slice("t", F.col("item_pos") + 1, F.col("length")))
    windows = windows.withColumn("plain", F.slice("plain", F.col("item_pos") + 1, F.col("length")))
    places = windows.select("*", F.posexplode("t").alias("place", "word")).where(~is_slot(F.col("word")) & (F.col("word") != ""))
    best = F.min_by(
        F.struct("place", "word"), F.struct(F.col("often"), -F.length("word"), F.col("place"))
    ).alias("anchor")
    keys = ["item_id", "n_words", "length", "item_pos", "t", "plain"]
    anchored = places.join(each, "word").groupBy(*keys).agg(best)
    beside = lambda k: F.when(~is_slot(F.get("t", k)), F.get("t", k))
    return anchored.select(
        *keys,
        "anchor.place",
        F.xxhash64("anchor.word").alias("key"),
        beside(F.col("anchor.place") - 1).alias("left_word"),
        beside(F.col("anchor.place") + 1).alias("right_word"),
    )


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 5,
    min_share: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(id, item_id, share, n_slots, n_changed)`` for each item that a text contains.

    ``share`` is the covered part of the item; ``n_slots`` counts the placeholder values in it, ``n_changed`` those
    that differ between text and item (0: the item stands there as it is, but for case and marks).
    """
    windows = stage(template_windows(benchmark, window, item_col, item_text_col), "template-windows")
    if windows.count() <= BROADCAST_WINDOWS:
        windows = F.broadcast(windows)
    texts = docs.where(F.length(text_col) > 0).select(F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("w"))
    placed = texts.select("id", "w", F.posexplode_outer("w").alias("pos", "word"))
    placed = placed.select("id", "w", "pos", F.xxhash64(F.lower(core(F.col("word")))).alias("key"))
    start = F.col("pos") - F.col("place")
    found = placed.join(windows, "key").where((start >= 1) & (start + F.col("length") <= F.size("w")))
    for name, step in (("left_word", -1), ("right_word", 1)):
        found = found.where(F.col(name).isNull() | (F.col(name) == F.lower(core(F.get("w", F.col("pos") + step)))))
    # The generated column keeps the comparison, which is not compiled, out of the compiled scan and join, so that
    # the words of a text are not copied for each of them.
    here = F.explode(F.array(F.slice("w", start, F.col("length") + 1))).alias("here")
    shift = (start - 1 - F.col("item_pos")).alias("shift")
    found = found.select("id", "item_id", "n_words", "length", "item_pos", "t", "plain", shift, here)
    found = found.where(F.col("t") == _template(F.col("here")))
    slots = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.col("length") - 1),
            lambda k: F.struct(
                F.get("t", k).alias("kind"),
                F.get("plain", k).alias("theirs"),
                core(F.get("here", k + 1)).alias("ours"),
            ),
        ),
        lambda s: is_slot(s["kind"]),
    )
    found = found.select("id", "item_id", "n_words", "length", "shift", "item_pos", slots.alias("slots"))
    found = found.withColumn("same", F.forall("slots", lambda s: F.lower(s["theirs"]) == F.lower(s["ours"])))
    lines = found.groupBy("id", "item_id", "n_words", "shift").agg(
        F.collect_set(F.struct("item_pos", "length", "same")).alias("places"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
        F.array_distinct(F.flatten(F.collect_set(F.when(F.col("same"), F.col("slots"))))).alias("same_slots"),
    )
    theirs = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["theirs"]))))
    ours = F.size(F.array_distinct(F.transform("slots", lambda s: F.struct(s["kind"], s["ours"]))))
    agree = (F.size("slots") == theirs) & (F.size("slots") == ours)
    lines = lines.select(
        "id", "item_id", "n_words",
        F.when(agree, F.col("places")).otherwise(F.filter("places", lambda p: p["same"])).alias("places"),
        F.when(agree, F.col("slots")).otherwise(F.col("same_slots")).alias("slots"),
    ).where(F.size("places") > 0)
    pairs = F.size("slots")
    changed = F.size(F.filter("slots", lambda s: F.lower(s["theirs"]) != F.lower(s["ours"])))
    covered = F.flatten(F.transform("places", lambda p: F.sequence(p["item_pos"], p["item_pos"] + p["length"] - 1)))
    lines = lines.select("id", "item_id", "n_words", covered.alias("covered"), pairs.alias("n_slots"), changed.alias("n_changed"))
    # The covered places are at most the item's words for each alignment; they go on as a set of single places.
    each = lines.select("id", "item_id", "n_words", "n_slots", "n_changed", F.explode("covered").alias("place"))
    items = each.groupBy("id", "item_id", "n_words").agg(
        F.size(F.collect_set("place")).alias("n_covered"),
        F.max("n_slots").cast("long").alias("n_slots"),
        F.min("n_changed").cast("long").alias("n_changed"),
    )
    share = F.col("n_covered") / F.col("n_words")
    return items.withColumn("share", share).where(F.col("share") >= min_share).select(
        "id", "item_id", "share", "n_slots", "n_changed"
    )
