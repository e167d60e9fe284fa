"""Which symbol lists and which index flags a numbered choice stands for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Choice number to the symbol lists it reads.
LIST_NAMES = {
    0: ["sp500_tickers", "nasdaq100_tickers", "nasdaq_all_tickers", "iwm1000_tickers"],
    1: ["sp500_tickers"],
    2: ["nasdaq100_tickers"],
    3: ["nasdaq_all_tickers"],
    4: ["iwm1000_tickers"],
    5: ["indexes_tickers"],
    6: ["portofolio_tickers"],
    7: ["etf_tickers"],
    8: ["test_tickers"],
}

# Choice number to the index flags it selects; none means the whole universe.
FLAG_NAMES = {
    0: [],
    1: ["SP500"],
    2: ["NASDAQ100"],
    3: ["NASDAQComposite"],
    4: ["Russell1000"],
    5: ["SP500", "NASDAQ100"],
    6: ["SP500", "NASDAQComposite"],
    7: ["SP500", "Russell1000"],
    8: ["NASDAQ100", "NASDAQComposite"],
    9: ["NASDAQ100", "Russell1000"],
    10: ["NASDAQComposite", "Russell1000"],
    11: ["SP500", "NASDAQ100", "NASDAQComposite"],
    12: ["SP500", "NASDAQ100", "Russell1000"],
    13: ["SP500", "NASDAQComposite", "Russell1000"],
    14: ["NASDAQ100", "NASDAQComposite", "Russell1000"],
    15: ["SP500", "NASDAQ100", "Russell1000", "NASDAQComposite"],
}

# Index names with a flag column of their own, and the seven of them written as lists.
KNOWN_INDEXES = [
    "S&P 500", "NASDAQ 100", "NASDAQ Composite", "Russell 1000", "Russell 3000", "Russell 2000",
    "S&P MidCap 400", "NASDAQ Bank", "NASDAQ Biotechnology", "S&P 500 Consumer Discretionary",
    "S&P 500 Health Care", "S&P 500 ESG",
]
LISTED_INDEXES = KNOWN_INDEXES[:7]

# Choices that always mean symbol lists.
LIST_ONLY_CHOICES = {5, 6, 7, 8}


def known_key(name: str) -> str:
    return name.replace(" ", "").replace("&", "")


KEY_TO_NAME = {known_key(name): name for name in KNOWN_INDEXES}


def parse_choice(choice: int | str) -> list[int]:
    """``3`` or ``"1-2-3"`` to numbers; parts of a dashed text that are no number are left out."""
    text = str(choice).strip()
    if "-" in text:
        return [int(p) for p in (q.strip() for q in text.split("-")) if p.isdigit()]
    if not text.isdigit():
        raise ValueError(f"invalid choice: {choice!r}")
    return [int(text)]


def choice_kind(choice: int | str) -> str:
    """``list`` when any list-only choice is asked for, else ``flags``."""
    return "list" if LIST_ONLY_CHOICES.intersection(parse_choice(choice)) else "flags"


def flags_for(choices: list[int]) -> list[str]:
    """All flags of the given choices, first seen first; an empty list means everything."""
    unknown = [c for c in choices if c not in FLAG_NAMES]
    if unknown or not choices:
        raise ValueError(f"no flags are defined for choice {unknown or choices}")
    if 0 in choices:
        return []
    return list(dict.fromkeys(f for c in choices for f in FLAG_NAMES[c]))


def lists_for(choices: list[int]) -> list[str]:
    unknown = [c for c in choices if c not in LIST_NAMES]
    if unknown:
        raise ValueError(f"no list is defined for choice {unknown}")
    return list(dict.fromkeys(n for c in choices for n in LIST_NAMES[c]))


def choice_map(spark: SparkSession) -> DataFrame:
    """The two tables above as one dimension: (choice, kind, key, pos). Its size is fixed."""
    rows = [
        (choice, kind, key, pos)
        for kind, table in (("list", LIST_NAMES), ("flags", FLAG_NAMES))
        for choice, keys in table.items()
        for pos, key in enumerate(keys)
    ]
    return spark.createDataFrame(rows, "choice int, kind string, key string, pos int")
