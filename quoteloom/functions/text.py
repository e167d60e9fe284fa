"""Text, number and boolean parsing."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\f\v"

# Spellings that count as a missing value in number columns.
MISSING_TEXT = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_VALUE = r"[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[iI]nf(?:inity)?|INF(?:INITY)?)"
NUMBER = rf"^\s*{_VALUE}\s*$"
NUMBER_OR_MISSING = rf"^\s*(?:{_VALUE}|{'|'.join(re.escape(m) for m in MISSING_TEXT)})\s*$"

# Spellings that count as true; everything else is false.
TRUE_TEXT = ["true", "1", "yes", "on"]


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def present(c: Column) -> Column:
    """``c`` with the missing-value spellings turned into NULL."""
    t = strip(c)
    return F.when(~t.isin(MISSING_TEXT), t)


def number(c: Column) -> Column:
    """Text to double; text that is no number gives NULL instead of failing.

    One pattern keeps the generated code short: a method the JVM deems too long is never compiled. It
    also refuses what only Java reads as a number, such as ``1.5d``.
    """
    return F.when(c.rlike(NUMBER), c).try_cast("double")


def nan_to_null(c: Column) -> Column:
    """Spark sorts NaN above all numbers and does not count it as NULL; keep only NULL."""
    return F.nullif(c, F.lit(float("nan")))


def missing(c: Column) -> Column:
    """True for NULL and NaN."""
    return c.isNull() | F.isnan(c)


def parses_or_missing(c: Column) -> Column:
    """True when the text is missing or a number."""
    return F.coalesce(c.rlike(NUMBER_OR_MISSING), F.lit(True))


def whole(c: Column) -> Column:
    """Number text to bigint, cut towards zero; NULL when it does not fit, as infinity."""
    return number(c).try_cast("bigint")


def boolean(c: Column) -> Column:
    """any of the true spellings, in any case and with blanks around it."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin(TRUE_TEXT), F.lit(False))


def dash_list(c: Column) -> Column:
    """``"1-2-x"`` to ``[1, 2]``; parts that are no whole number are left out."""
    parts = F.transform(F.split(c, "-"), lambda x: strip(x).try_cast("int"))
    return F.filter(parts, lambda x: x.isNotNull())


def cents(c: Column) -> Column:
    """Price in whole cents, so that sums do not depend on the order of addition."""
    return F.floor(c * F.lit(100.0) + F.lit(0.5))


def exact(c: Column) -> Column:
    """Price as a decimal with eight places, so that sums do not depend on the order of addition.

    NULL, NaN, infinity and prices of 10**15 and more are missing.
    """
    kept = F.when(~F.isnan(c) & (F.abs(c) < F.lit(1e15)), c)
    return kept.cast("decimal(24,8)")


def exact_mean(total: Column, count: Column) -> Column:
    """Sum through count, NULL for none."""
    return F.when(count > 0, total.cast("double") / count.cast("double"))


def order_key(major: Column, minor: Column) -> Column:
    """One fixed-width sort key for (major, minor), two 64-bit integers.

    ``min_by``/``max_by`` over a struct force a sort-based aggregate; over this key Spark keeps the
    hash aggregate. The factor exceeds the range of a bigint, so the order is exact for all values.
    """
    step = F.lit("20000000000000000000").cast("decimal(20,0)")
    return major.cast("decimal(17,0)") * step + minor.cast("decimal(19,0)")
