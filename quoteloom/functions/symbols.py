"""Symbol cleaning (P1a-P1d) and the index-name keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quoteloom.functions.text import strip


# A name with something in it and no slash; the same without a backslash; the text nan.
NAME = r"^[^/]*[^/\s][^/]*$"
WEB_NAME = r"^[^/\\]*[^/\\\s][^/\\]*$"
NAN_TEXT = r"(?i)^\s*nan\s*$"


def _class_shares(c: Column) -> Column:
    return F.translate(strip(c), ".", "-")


def clean_symbol(c: Column) -> Column:
    """P1a, P1d: trim, class-share dots to dashes; NULL for names with a slash and for blanks."""
    return F.when(c.rlike(NAME), _class_shares(c))


def clean_batch_symbol(c: Column) -> Column:
    """As :func:`clean_symbol`, and the text ``nan`` in any case is no symbol."""
    return F.when(c.rlike(NAME) & ~c.rlike(NAN_TEXT), _class_shares(c))


def clean_web_symbol(c: Column) -> Column:
    """As :func:`clean_symbol`, and names with a backslash are left out too."""
    return F.when(c.rlike(WEB_NAME), _class_shares(c))


def index_names(c: Column) -> Column:
    """``"S&P 500, NASDAQ 100,"`` to an array of distinct non-empty names.

    Blanks around commas go in one replacement: higher-order functions are interpreted, these are not.
    """
    parts = F.split(F.regexp_replace(strip(c), r"\s*,\s*", ","), ",")
    return F.array_distinct(F.array_remove(parts, ""))


def index_keys_of(names: Column) -> Column:
    """F5 for a whole array of names; a name never holds a comma, so one text serves for all of them."""
    return F.array_distinct(F.array_remove(F.split(index_key(F.array_join(names, ",")), ","), ""))


def index_key(c: Column) -> Column:
    """index name to key, for any name that may occur."""
    return F.translate(c, " &-./()", "")


def known_index_key(c: Column) -> Column:
    """key of a known index name; blanks and ampersands go, other characters stay."""
    return F.translate(c, " &", "")


def exchange_name(c: Column) -> Column:
    """Exchange letter of a directory line."""
    return F.when(c == "Q", "NASDAQ").when(c == "N", "NYSE").otherwise("OTHER")
