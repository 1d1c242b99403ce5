"""Scores: tenure, capped sums and rule tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike


def tenure_months(opened: str, date: DateLike) -> Column:
    """Whole months from the month after opening to ``date``."""
    start = F.add_months(F.trunc(p.day_of(opened), "month"), 1)
    return F.months_between(p.date_lit(date), start).cast("int")


def tenure_score(
    df: DataFrame, opened: str, flags: Sequence[str], date: DateLike
) -> DataFrame:
    """0/1 from three monthly flags (this month, last month, the one before),
    weighed by how long the customer is known.

    Three months or more: at least two flags.  Two months: at least one of the
    newest two.  One month: the newest flag.  Otherwise 0.
    """
    f0, f1, f2 = (F.col(f) for f in flags)
    out = df.withColumn("tenure_months", tenure_months(opened, date))
    tenure = F.col("tenure_months")
    score = (
        F.when(tenure >= 3, (f0 + f1 + f2 >= 2).cast("int"))
        .when(tenure == 2, (f0 + f1 >= 1).cast("int"))
        .when(tenure == 1, f0)
        .otherwise(0)
    )
    return out.withColumn("tenure_score", F.coalesce(score, F.lit(0)))


def capped_score(
    df: DataFrame, parts: dict[str, float], cap: float = 1.5, name: str = "score"
) -> DataFrame:
    """Weighted sum of 0/1 (or numeric) parts, at most ``cap``; a missing part is 0."""
    weighted = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) * F.lit(w) for c, w in parts.items()]
    return df.withColumn(name, F.least(F.lit(cap), reduce(add, weighted)))


def stepped_score(column: str, name: str, steps: Sequence[tuple[float, float]]) -> Column:
    """Score of the first step whose threshold the value reaches, else 0.

    ``steps`` lists ``(at_least, score)`` from the highest threshold down.
    """
    score = F.when(F.lit(False), F.lit(0.0))
    for at_least, value in steps:
        score = score.when(F.col(column) >= at_least, F.lit(float(value)))
    return score.otherwise(F.lit(0.0)).alias(name)


def decimal_comma(column: str) -> Column:
    """``'0,5'`` as the number 0.5; null when it is no number."""
    return F.regexp_replace(column, ",", ".").try_cast("decimal(9,3)")


def score_lookup(
    df: DataFrame, rules: DataFrame, scores: Sequence[str], scale: int = 1
) -> DataFrame:
    """Look up a combination of scores in a rule table.

    Both sides are compared as decimals: a float and a double of the same text are
    not equal in general.  There are few combinations and each has many rows, so
    the rules are broadcast if counting shows that they are as small as they should.
    """
    kind = f"decimal({scale + 8},{scale})"
    keyed = rules.select(
        *[F.col(s).cast(kind).alias(f"__{s}") for s in scores],
        *[c for c in rules.columns if c not in scores],
    )
    match = reduce(
        lambda a, b: a & b, [df[s].cast(kind) == keyed[f"__{s}"] for s in scores]
    )
    return df.join(keyed, match, "left").drop(*[f"__{s}" for s in scores])
