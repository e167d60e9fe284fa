"""Dates in names, stored dates with a zone suffix, and period texts."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date in a file name, zone suffix at the end of a stored date, suffix when none is stored.
FILE_DATE = r"(\d{4}-\d{2}-\d{2})"
ZONE_SUFFIX = r"([+-]\d{2}:\d{2})$"
DEFAULT_SUFFIX = "-05:00"

# First history date per interval.
HISTORY_START = {"1d": "2020-01-01", "1wk": "2000-01-01", "1mo": "2000-01-01"}


def file_date(name: Column) -> Column:
    """Date in a file name; NULL when there is none or it is no calendar date."""
    return F.try_to_date(F.nullif(F.regexp_extract(name, FILE_DATE, 1), F.lit("")), "yyyy-MM-dd")


def stored_day(text: Column) -> Column:
    """Calendar day of ``2025-09-05 00:00:00-04:00``; the session zone cannot shift it."""
    return F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")


def zone_suffix(text: Column) -> Column:
    """Zone suffix of a stored date, NULL when it has none."""
    return F.nullif(F.regexp_extract(text, ZONE_SUFFIX, 1), F.lit(""))


def with_suffix(day: Column, suffix: Column) -> Column:
    """day and suffix to the stored form, for a date column or a date text.

    A text that already holds the suffix stays as it is.
    """
    text = day.cast("string")
    full = F.concat(F.substring(text, 1, 10), F.lit(" 00:00:00"), suffix)
    return F.when(F.contains(text, suffix), text).otherwise(full)


def resolve_range(start: str | None, end: str | None, today: date) -> tuple[str | None, str | None]:
    """P10: blank or ``nan`` start means no range; end ``today`` is the given day."""
    first = (start or "").strip()
    last = (end or "").strip()
    if last.lower() == "today":
        last = today.isoformat()
    return (None if first.lower() in ("", "nan") else first), (last or None)


def parse_period(period: str) -> tuple[str, int]:
    """``5d``/``3mo``/``2y``/``ytd``/``max`` to (unit, count)."""
    text = period.strip().lower()
    if text in ("ytd", "max"):
        return text, 0
    m = re.fullmatch(r"([1-9]\d*)(d|mo|y)", text)
    if not m:
        raise ValueError(f"unknown period: {period!r}")
    return m.group(2), int(m.group(1))
