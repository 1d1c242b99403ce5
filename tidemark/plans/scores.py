"""The activity score: four partial scores and a rule table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import scores as s
from tidemark.operators.joins import as_list
from tidemark.operators.shaping import pivot_counts

SCORES = ("inflow_score", "transaction_score", "digital_score", "equipment_score")

# What a channel adds to the transaction score.
CHANNEL_WEIGHTS = {"transfer": 0.5, "order": 0.5, "withdrawal": 0.5, "cheque": 0.5, "card": 1.0}


def transaction_score(transactions: DataFrame, date: DateLike) -> DataFrame:
    """Channels used in the month of ``date``: ``transactions(customer, day, channel)``."""
    month = p.Bounds(p.period_start(date, "month"), p.as_date(date))
    used = transactions.where(p.within(p.day_of("day"), month)).groupBy("customer").agg(
        *[
            F.max((F.col("channel") == channel).cast("int")).alias(f"uses_{channel}")
            for channel in CHANNEL_WEIGHTS
        ]
    )
    weights = {f"uses_{channel}": w for channel, w in CHANNEL_WEIGHTS.items()}
    return s.capped_score(used, weights, name="transaction_score").select("customer", "transaction_score")


def digital_score(
    connections: DataFrame, operations: DataFrame, kinds: Sequence[str], date: DateLike
) -> DataFrame:
    """0.5 for a connection this month and 0.5 for a digital operation.

    ``connections(customer, day)``, ``operations(customer, day, kind)``.
    """
    month = p.Bounds(p.period_start(date, "month"), p.as_date(date))
    connected = connections.where(p.within(p.day_of("day"), month)).groupBy("customer").agg(
        F.count("*").alias("connections")
    )
    counts = pivot_counts(
        operations.where(p.within(p.day_of("day"), month)), "customer", "kind", kinds
    )
    total = sum((F.col(f"{kind}_count") for kind in kinds[1:]), F.col(f"{kinds[0]}_count"))
    operated = counts.select("customer", total.alias("operations"))
    joined = connected.join(operated, "customer", "full")
    half = [
        F.when(F.col(c) > 0, F.lit(0.5)).otherwise(F.lit(0.0)) for c in ("connections", "operations")
    ]
    return joined.select("customer", (half[0] + half[1]).alias("digital_score"))


def equipment_score(holdings: DataFrame, families: Sequence[str]) -> DataFrame:
    """Families in which the customer holds contracts: 1 for more than one contract,
    0.5 for one, at most 1.5 in total.  ``holdings(customer, family, product,
    contract)``; a contract counts once per product."""
    per_product = holdings.groupBy("customer", "family", "product").agg(
        F.count_distinct("contract").alias("n")
    )
    counts = pivot_counts(per_product, "customer", "family", families, {"held": F.sum("n")}, ["held"])
    stepped = counts.select(
        "customer",
        *[s.stepped_score(f"{family}_held", f"score_{family}", [(2, 1.0), (1, 0.5)]) for family in families],
    )
    parts = {f"score_{family}": 1.0 for family in families}
    return s.capped_score(stepped, parts, name="equipment_score").select("customer", "equipment_score")


def activity_score(
    month_flags: DataFrame,
    transactions: DataFrame,
    connections: DataFrame,
    operations: DataFrame,
    holdings: DataFrame,
    rules: DataFrame,
    date: DateLike,
    kinds: Sequence[str],
    families: Sequence[str],
    keep: str | Sequence[str] = (),
) -> DataFrame:
    """The four scores of each customer and the level the rule table gives them.

    ``month_flags(customer, opened, flag_m_0, flag_m_1, flag_m_2)`` has the
    customers; ``rules`` the four scores and whatever they lead to.
    """
    tenure = s.tenure_score(month_flags, "opened", ["flag_m_0", "flag_m_1", "flag_m_2"], date)
    base = tenure.select(
        "customer", *as_list(keep), F.col("tenure_score").cast("double").alias("inflow_score")
    )
    joined = (
        base.join(transaction_score(transactions, date), "customer", "left")
        .join(digital_score(connections, operations, kinds, date), "customer", "left")
        .join(equipment_score(holdings, families), "customer", "left")
        .fillna(0.0, list(SCORES))
    )
    return s.score_lookup(joined, rules, list(SCORES))
