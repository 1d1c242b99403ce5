"""Acquisition, churn and activity changes of customers.

Each flag comes in four periods: the snapshot's week, month, quarter and year.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators.joins import with_group_totals

UNITS = p.UNITS


def _same_period(day: Column, at: Column, unit: str) -> Column:
    return p.period_of(day, unit) == p.period_of(at, unit)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def acquisition_flags(
    df: DataFrame,
    keys: str | Sequence[str],
    opened: str,
    snapshot: str,
    adult: Column | None = None,
) -> DataFrame:
    """Was the key's first (adult) account opened in the snapshot's period?

    Adds ``first_opened`` and ``acquired_<unit>``; with ``adult``, accounts for
    which it does not hold are ignored.
    """
    day = p.day_of(opened)
    counted = day if adult is None else F.when(adult, day)
    out = with_group_totals(df, keys, {"first_opened": F.min(counted)})
    return out.select(
        "*",
        *[
            _flag(_same_period(F.col("first_opened"), p.day_of(snapshot), unit)).alias(
                f"acquired_{unit}"
            )
            for unit in UNITS
        ],
    )


def active_acquisition_flags(df: DataFrame, active: Column, owns: Column) -> DataFrame:
    """Acquired, active now and owning the products asked for."""
    return df.select(
        "*",
        *[
            _flag((F.col(f"acquired_{unit}") == 1) & active & owns).alias(
                f"acquired_active_{unit}"
            )
            for unit in UNITS
        ],
    )


def churn_flags(
    df: DataFrame, keys: str | Sequence[str], is_open: Column, closed: str, snapshot: str
) -> DataFrame:
    """All accounts of the key are closed and one of them was closed in the period.

    Adds ``last_closed``, ``all_closed`` and ``churned_<unit>``, the same on every
    row of a key.  A key whose open state is unknown throughout is not churned.
    """
    day, at = p.day_of(closed), p.day_of(snapshot)
    out = with_group_totals(
        df,
        keys,
        {
            "last_closed": F.max(day),
            "all_closed": F.max(is_open.cast("int")) == 0,
            **{f"__in_{u}": F.max(_flag(_same_period(day, at, u))) for u in UNITS},
        },
    )
    return out.select(
        *df.columns,
        "last_closed",
        _flag(F.col("all_closed")).alias("all_closed"),
        *[
            _flag((F.col(f"__in_{u}") == 1) & F.col("all_closed")).alias(f"churned_{u}")
            for u in UNITS
        ],
    )


def transition_flags(
    df: DataFrame, kind: str, state: str, active: str, units: Sequence[str] = UNITS
) -> DataFrame:
    """Compare the state with the one of the previous observed periods, which are
    in ``prev_<unit>_<state>``.

    ``reactivated``: active now, not active (or unknown) then.
    ``inactivated``: not active (or unknown) now, active then.
    """
    now = F.coalesce(F.col(state) == active, F.lit(False))
    made = []
    for unit in units:
        then = F.coalesce(F.col(f"prev_{unit}_{state}") == active, F.lit(False))
        changed = {"reactivated": now & ~then, "inactivated": ~now & then}[kind]
        made.append(changed.cast("int").alias(f"{kind}_{unit}"))
    return df.select("*", *made)


def active_delta(
    df: DataFrame,
    state: str,
    previous: str,
    is_open: Column,
    active: str,
    inactive: str,
    name: str = "active_delta",
) -> DataFrame:
    """+1 for a key that became active (or is new and active), -1 for one that
    became inactive while its account is open, 0 otherwise."""
    now, then = F.col(state), F.col(previous)
    gained = (now == active) & (then.isNull() | (then == inactive))
    lost = is_open & (now == inactive) & (then == active)
    return df.select("*", F.when(gained, 1).when(lost, -1).otherwise(0).alias(name))
