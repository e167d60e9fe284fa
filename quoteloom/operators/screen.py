"""Growth score and screen over company fundamentals.

Everything but the funnel counts is row-local: no shuffle at any size. Score and screen are optional:
the fundamentals job only runs them when asked to.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quarter slots looked at, and values needed, for growth acceleration.
ACCELERATION_SLOTS = 8
ACCELERATION_NEEDED = 4

# Score steps as (limit, points), first limit passed counts.
CURRENT_STEPS = [(0.25, 25), (0.10, 15), (0.0, 5)]
ANNUAL_STEPS = [(0.20, 15), (0.10, 10), (0.0, 3)]
RETURN_STEPS = [(0.15, 5)]
NEW_POINTS = 7
SHORT_STEPS = [(0.10, 8), (0.20, 5)]
HELD_RANGE, HELD_POINTS, HELD_ABOVE, HELD_LESS_POINTS = (0.40, 0.80), 7, 0.20, 3
CAP_STEPS = [(2_000_000_000.0, 10), (300_000_000.0, 5)]
ANALYST_STEPS = [(3.0, 10), (1.0, 5)]

# Screening criteria as (column, comparison, limit), in order.
CRITERIA = [
    ("earningsQuarterlyGrowth", ">", 0.20),
    ("earningsGrowth", ">", 0.15),
    ("shortPercentOfFloat", "<", 0.20),
    ("marketCap", ">", 300_000_000.0),
]


def _compare(c: Column, op: str, limit: float) -> Column:
    return {">": c > limit, ">=": c >= limit, "<": c < limit}[op]


def _points(c: Column, op: str, steps: list[tuple[float, int]]) -> Column:
    """Points of the first step ``c`` passes; a missing value earns none."""
    out = F.lit(0)
    for limit, points in reversed(steps):
        out = F.when(_compare(c, op, limit), points).otherwise(out)
    return out


def acceleration(values: list[Column]) -> Column:
    """A10: mean of the 2 newest values against the mean of the 2 before, in percent.

    ``values`` are newest first; missing ones are skipped, four have to remain, and a prior mean of
    zero gives NULL. Works on the wide row's own columns.
    """
    kept = F.filter(F.array(*values), lambda x: x.isNotNull())
    recent = (F.get(kept, F.lit(0)) + F.get(kept, F.lit(1))) / 2
    prior = (F.get(kept, F.lit(2)) + F.get(kept, F.lit(3))) / 2
    change = F.try_divide(recent - prior, F.abs(prior)) * 100
    return F.when(F.size(kept) >= ACCELERATION_NEEDED, change)


def growth_acceleration(wide: DataFrame) -> DataFrame:
    """A10 for net income and revenue of the fundamentals table."""
    slots = range(1, ACCELERATION_SLOTS + 1)
    return wide.withColumns(
        {
            "earnings_acceleration": acceleration([F.col(f"q{i}_net_income") for i in slots]),
            "revenue_acceleration": acceleration([F.col(f"q{i}_revenue") for i in slots]),
        }
    )


def score(table: DataFrame) -> DataFrame:
    """Points per letter, their sum and percentage; 87 of 100 can be reached."""
    held = F.col("heldPercentInstitutions")
    held_points = (
        F.when(held.between(*HELD_RANGE), HELD_POINTS)
        .when(held > HELD_ABOVE, HELD_LESS_POINTS)
        .otherwise(0)
    )
    letters = {
        "c_points": _points(F.col("earningsQuarterlyGrowth"), ">", CURRENT_STEPS),
        "a_points": _points(F.col("earningsGrowth"), ">", ANNUAL_STEPS)
        + _points(F.col("returnOnEquity"), ">", RETURN_STEPS),
        "n_points": F.lit(NEW_POINTS),
        "s_points": _points(F.col("shortPercentOfFloat"), "<", SHORT_STEPS) + held_points,
        "l_points": _points(F.col("marketCap"), ">", CAP_STEPS),
        "i_points": _points(F.col("numberOfAnalystOpinions"), ">=", ANALYST_STEPS),
    }
    scored = table.withColumns(letters)
    total = reduce(lambda a, b: a + b, [F.col(n) for n in letters])
    return scored.withColumn("canslim_score", total).withColumn(
        "canslim_score_percentage", F.col("canslim_score").cast("double")
    )


def _criteria(table: DataFrame) -> list[tuple[str, Column, Column]]:
    """(name, passes, has a value) of the criteria whose column exists; a missing value fails."""
    return [
        (name, F.coalesce(_compare(F.col(name), op, limit), F.lit(False)), F.col(name).isNotNull())
        for name, op, limit in CRITERIA
        if name in table.columns
    ]


def screen(table: DataFrame) -> DataFrame:
    """P20: rows that pass every criterion whose column exists."""
    passes = [p for _, p, _ in _criteria(table)]
    return table.filter(reduce(lambda a, b: a & b, passes)) if passes else table


def funnel(table: DataFrame) -> DataFrame:
    """Per criterion the rows that pass it, that have a value, and that are left so far.

    One pass over the table with a handful of counters, then one row per criterion.
    """
    found = _criteria(table)
    counters, left = [], F.lit(True)
    for i, (_, passes, known) in enumerate(found):
        left = left & passes
        counters += [
            F.count_if(passes).alias(f"_met{i}"),
            F.count_if(known).alias(f"_known{i}"),
            F.count_if(left).alias(f"_left{i}"),
        ]
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"), F.lit(name).alias("criterion"),
                F.col(f"_met{i}").alias("met"), F.col(f"_known{i}").alias("known"),
                F.col(f"_left{i}").alias("remaining"),
            )
            for i, (name, _, _) in enumerate(found)
        ]
    )
    return table.agg(*counters).select(F.inline(steps))


def top(table: DataFrame, n: int = 5) -> DataFrame:
    """The n best scores; ties in symbol order."""
    return table.orderBy(F.desc_nulls_last("canslim_score"), "symbol").limit(n)
