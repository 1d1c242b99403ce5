"""Savings accounts, overdrafts and insurance contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import comparison as c
from tidemark.operators import flags as f
from tidemark.operators.shaping import routed_union


def _rolled_in_period(df: DataFrame, key: str, day: str, date: DateLike, name: str) -> DataFrame:
    return f.rolled_up(df, key, f.in_period_columns(p.day_of(day), date, name), name)


def savings_flags(
    accounts: DataFrame,
    history: DataFrame,
    balances: DataFrame,
    date: DateLike,
    savings_kinds: Sequence[str],
    closed: str,
    funded_from: int = 1000,
) -> DataFrame:
    """Savings accounts: opened in the period, open in some snapshot of it, owned by a
    customer with nothing but savings accounts in some snapshot of it, and funded.

    ``accounts(account, customer, kind, opened)``, ``history(account, customer, kind,
    state, snapshot)``, ``balances(account, snapshot, credit)``.
    """
    is_savings = F.col("kind").isin(*savings_kinds)
    alive = history.where(F.col("state") != closed)
    only = (
        alive.groupBy("customer", "snapshot")
        .agg(F.min(is_savings).alias("only"))
        .where("only")
    )
    funded = balances.where(F.col("credit") >= funded_from)
    out = f.in_period_flags(accounts.where(is_savings), "opened", date, "subscribed")
    out = out.join(_rolled_in_period(alive, "account", "snapshot", date, "open"), "account", "left")
    out = out.join(_rolled_in_period(only, "customer", "snapshot", date, "savings_only"), "customer", "left")
    out = out.join(_rolled_in_period(funded, "account", "snapshot", date, "funded"), "account", "left")
    return f.fill_flags(out, ["subscribed", "open", "savings_only", "funded"])


def overdraft_flags(
    authorizations: DataFrame, balances: DataFrame, date: DateLike, notified_state: str
) -> DataFrame:
    """Overdraft authorizations: agreed in the period, in force at its close, and used.

    ``authorizations(number, account, state, since, until)`` may have several rows per
    number; ``balances(account, day, debit)``.  Used means in force and overdrawn on
    some day of the period.
    """
    since, until = p.day_of("since"), p.day_of("until")
    in_force = f.rolled_up(
        authorizations.where(F.col("state") == notified_state),
        "number", f.active_at_columns(since, until, date, "notified"), "notified",
    )
    overdrawn = _rolled_in_period(balances.where("debit > 0"), "account", "day", date, "used")
    agreed = f.rolled_up(
        authorizations, ["number", "account"],
        f.in_period_columns(since, date, "subscribed"), "subscribed",
    )
    out = agreed.join(in_force, "number", "left").join(overdrawn, "account", "left")
    filled = f.fill_flags(out, ["subscribed", "notified", "used"])
    both = zip(p.flag_names("used"), p.flag_names("notified"), strict=True)
    return filled.withColumns({used: F.col(used) * F.col(notified) for used, notified in both})


def insurance_outstanding(
    insurers: Sequence[DataFrame],
    contracts: DataFrame,
    date: DateLike,
    valid_states: Sequence[str],
) -> DataFrame:
    """Outstanding amounts per insurance contract on a day and at the ends of earlier
    periods; 0 where there was none.

    ``insurers`` are one frame each with ``(insurer, contract, day, amount)`` and
    perhaps ``product``; ``contracts(contract, account, product, state, since)``.  An
    insurer that reports the product must agree with the contract; the largest amount
    reported for a day counts.
    """
    valid = contracts.where(F.col("state").isin(*valid_states)).select(
        "contract", "account", "product", "since"
    ).distinct()
    reported = routed_union(insurers).withColumnRenamed("product", "reported")
    agrees = F.col("reported").isNull() | (F.col("reported") == F.col("product"))
    ids = ["insurer", "account", "contract", "product", "since"]
    daily = reported.join(valid, "contract").where(agrees).groupBy(*ids, "day").agg(
        F.max("amount").alias("amount")
    )
    periods = [("week", 1), ("week", 2), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1)]
    now = c.values_as_of(daily, "amount", date, periods, ids, "day")
    past = [c.past_name("amount", unit, n) for unit, n in periods]
    return now.where("amount IS NOT NULL").fillna(0, past)
