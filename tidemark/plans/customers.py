"""Customer status, customer KPIs and the portfolio's lifecycle report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import comparison, flags, lifecycle, money

# Balances that make an account count, by market, and limits.
BALANCE_LIMITS = {"RETAIL": 500, "PRO": 2500}
ENGAGED_FROM = 100
ENTRY_FLOW = 2000
ENTRY_MONTHS = 36
ACTIVE_MONTHS = 6


def _any(condition: Column) -> Column:
    return F.max(F.coalesce(condition, F.lit(False)))


def customer_status(
    customers: DataFrame,
    accounts: DataFrame,
    balances: DataFrame,
    movements: DataFrame,
    rates: DataFrame,
    operations: DataFrame,
    date: DateLike,
    loan_kinds: Sequence[str],
    resource_kinds: Sequence[str],
    home: str,
    limits: dict[str, int] | None = None,
    engaged_from: int = ENGAGED_FROM,
    entry_flow: int = ENTRY_FLOW,
) -> DataFrame:
    """Active, inactive, entering or newly acquired, per customer.

    ``customers(customer, opened, market)``, ``accounts(account, customer)``,
    ``balances(account, debit, credit, kind)``, ``movements(account, day, currency,
    amount, side, operation)``, ``rates(currency, quote_date, mid)`` and
    ``operations(operation)``, those a customer starts.

    Every input is reduced to one row per account before it is joined, and all
    these joins are on the account.  Whether the list of operations is broadcast is
    Spark's choice by its measured size.  Customers of other markets than those with a balance limit are left out.
    """
    limits = limits or BALANCE_LIMITS
    flow = money.credit_flow(
        movements, rates, "account", "day", "currency", "amount", "side", home
    )
    recent = (
        movements.where(p.within(p.day_of("day"), p.rolling_bounds(date, ACTIVE_MONTHS)))
        .join(operations, "operation", "left_semi")
        .groupBy("account")
        .agg(F.lit(True).alias("moved"))
    )
    held = balances.groupBy("account").agg(
        F.max("credit").alias("credit"),
        _any(F.col("kind").isin(*loan_kinds) & (F.col("debit") >= engaged_from)).alias("engaged"),
        _any(F.col("kind").isin(*resource_kinds) & (F.col("credit") >= engaged_from)).alias("saver"),
    )
    per_account = (
        accounts.join(flow, "account", "left").join(recent, "account", "left").join(held, "account", "left")
    )
    per_customer = per_account.groupBy("customer").agg(
        F.sum("credit_flow").alias("credit_flow"),
        F.max("credit").alias("credit"),
        _any(F.col("moved")).alias("moved"),
        _any(F.col("engaged")).alias("engaged"),
        _any(F.col("saver")).alias("saver"),
    )
    opened = p.day_of("opened")
    entry = p.Bounds(p.rolling_bounds(date, ENTRY_MONTHS).start, p.as_date(date) - timedelta(days=1))
    limit = F.when(F.lit(False), F.lit(0))
    for market, value in limits.items():
        limit = limit.when(F.col("market") == market, F.lit(value))
    base = customers.where(F.col("market").isin(*limits))
    known = base.join(per_customer, "customer", "left").select(
        "customer",
        "credit_flow",
        F.coalesce(p.within(opened, entry) & (F.col("credit_flow") < entry_flow), F.lit(False)).alias("entering"),
        F.coalesce(
            F.coalesce(F.col("credit") >= limit, F.lit(False)) | F.col("moved") | F.col("engaged") | F.col("saver"),
            F.lit(False),
        ).alias("any_rule"),
        F.coalesce(p.within(opened, p.period_bounds(date, "year")), F.lit(False)).alias("acquired"),
    )
    active = F.col("any_rule") & ~F.col("entering")
    return known.select(
        "customer",
        "credit_flow",
        active.cast("int").alias("is_active"),
        (~active & ~F.col("entering")).cast("int").alias("is_inactive"),
        F.col("entering").cast("int").alias("is_entering"),
        (active & F.col("acquired")).cast("int").alias("is_acquired_active"),
    )


def customer_kpis(
    customers: DataFrame,
    accounts: DataFrame,
    movements: DataFrame,
    status_history: DataFrame,
    date: DateLike,
    threshold: int = ENTRY_FLOW,
) -> DataFrame:
    """Acquisitions per period, split by credit flow, with the activity history.

    ``customers(customer, opened)``, ``accounts(account, customer)``,
    ``movements(account, day, amount)`` in home currency, credits only, and
    ``status_history(customer, day, is_active)``.

    A period's flow counts from its start on; the earlier year's is its last
    quarter, so acquisitions of that year count from then too.
    """
    sums = money.roll_up(
        money.sums_since(movements, "account", "day", F.col("amount"), money.since_bounds(date)),
        accounts, "account", "customer",
    )
    history = comparison.values_as_of(
        status_history, "is_active", date,
        [("week", 1), ("month", 1), ("quarter", 1), ("year", 1)], "customer", "day",
    )
    acquired = flags.in_period_flags(customers, "opened", date, "acquired")
    joined = acquired.join(sums, "customer", "left").join(history, "customer", "left")
    in_last_quarter = F.quarter(p.day_of("opened")) == 4
    made = []
    for suffix in money.since_bounds(date):
        new = F.coalesce(F.col(f"is_acquired_{suffix}"), F.lit(False))
        if suffix == "y_1":
            new = F.coalesce(new & in_last_quarter, F.lit(False))
        flow = F.coalesce(F.col(f"sum_{suffix}"), F.lit(0))
        made += [
            new.cast("int").alias(f"acquired_{suffix}"),
            (new & (flow >= threshold)).cast("int").alias(f"acquired_active_{suffix}"),
            (new & (flow < threshold)).cast("int").alias(f"acquired_ongoing_{suffix}"),
        ]
    past = [c for c in history.columns if c != "customer"]
    return joined.select("customer", *made, F.coalesce("sum_y", F.lit(0)).alias("flow_year"), *past)


def portfolio_report(
    states: DataFrame,
    accounts: DataFrame,
    date: DateLike,
    active: str,
    owns: Column,
) -> DataFrame:
    """Acquired, active acquired, churned, reactivated and inactivated customers.

    ``states(customer, day, state)`` is the status history, one row per customer
    and day; ``accounts(customer, opened, closed, is_open, adult, ...)`` are the
    accounts as of ``date``.  One row per customer with a status on the date.
    """
    history = comparison.prev_observed_state(
        states.where(p.day_of("day") <= p.date_lit(date)), "state", list(p.UNITS), "customer", "day"
    )
    today = history.where(p.day_of("day") == p.date_lit(date))
    for kind in ("reactivated", "inactivated"):
        today = lifecycle.transition_flags(today, kind, "state", active)
    snapshot = accounts.withColumn("snapshot", p.date_lit(date))
    owned = snapshot.groupBy("customer").agg(
        F.min(F.when(F.col("adult"), p.day_of("opened"))).alias("opened"),
        F.max("snapshot").alias("snapshot"),
        F.max(p.day_of("closed")).alias("last_closed"),
        (F.max(F.col("is_open").cast("int")) == 0).alias("all_closed"),
        *[
            _any(p.period_of(p.day_of("closed"), u) == p.period_of(F.col("snapshot"), u)).alias(f"__closed_{u}")
            for u in p.UNITS
        ],
        _any(owns).alias("__owns"),
    )
    joined = today.join(owned, "customer", "left")
    made = []
    for u in p.UNITS:
        new = F.coalesce(p.period_of(F.col("opened"), u) == p.period_of(F.col("snapshot"), u), F.lit(False))
        gone = F.coalesce(F.col(f"__closed_{u}") & F.col("all_closed"), F.lit(False))
        here = F.coalesce(F.col("__owns") & (F.col("state") == active), F.lit(False))
        made += [
            new.cast("int").alias(f"acquired_{u}"),
            (new & here).cast("int").alias(f"acquired_active_{u}"),
            gone.cast("int").alias(f"churned_{u}"),
        ]
    return joined.select(
        *today.columns, F.col("opened").alias("first_opened"), "last_closed", *made
    )
