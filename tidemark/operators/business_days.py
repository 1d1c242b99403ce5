"""Business-day calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p

# The weekend (Sunday is 1).
WEEKEND = (1, 7)


def previous_business_day(
    df: DataFrame,
    holidays: DataFrame,
    col: str,
    back: int = 1,
    holiday: str = "holiday",
    name: str = "business_day",
    window: int = 7,
) -> DataFrame:
    """Add the latest day in ``[col - back - window, col - back]`` that is neither on a
    weekend nor a holiday.  All rows are kept: one without such a day, or without a
    date, has a null.

    The calendar is worked out for the distinct days of ``col`` only, which are
    bounded by the calendar, and joined back; the rows are not multiplied.
    """
    days = df.select(p.day_of(col).alias("__day")).distinct()
    offsets = F.sequence(F.date_sub("__day", back + window), F.date_sub("__day", back))
    candidates = days.select("__day", F.explode(offsets).alias("__candidate")).where(
        ~F.dayofweek("__candidate").isin(*WEEKEND)
    )
    closed = holidays.select(p.day_of(holiday).alias("__candidate"))
    chosen = (
        candidates.join(closed, "__candidate", "left_anti")
        .groupBy("__day")
        .agg(F.max("__candidate").alias(name))
    )
    # one row per calendar day, however many rows df has: safe to broadcast
    return df.join(F.broadcast(chosen), p.day_of(df[col]) == chosen["__day"], "left").drop("__day")
