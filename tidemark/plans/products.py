"""Products: contract flags, card transactions and direct debits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import flags as f
from tidemark.operators.joins import attach
from tidemark.operators.latest import valid_at
from tidemark.operators.shaping import Dimension, route, star_enrich

PRODUCT_FLAGS = ("subscribed", "valid", "withdrawn", "active", "activated")


def product_flags(
    contracts: DataFrame,
    history: DataFrame,
    withdrawals: DataFrame,
    uses: DataFrame,
    date: DateLike,
    valid_states: Sequence[str],
    within_period: bool = False,
) -> DataFrame:
    """Five sets of period flags per contract, as 0/1.

    ``contracts(contract, card, subscribed_on, ...)``, ``history(contract, state,
    snapshot)``, ``withdrawals(card, withdrawn_on)``, ``uses(card, used_at)``.

    Subscribed in the period; valid in some snapshot up to its close; withdrawn by
    then; used in the three months before; used for the first time by then.  With
    ``within_period``, valid and withdrawn look at the period itself and not at all
    the time up to its close.
    """

    def seen(df: DataFrame, key: str, day: str, name: str) -> DataFrame:
        if within_period:
            return f.rolled_up(df, key, f.in_period_columns(p.day_of(day), date, name), name)
        # some date is not after the close exactly when the first one is not
        return f.first_event_flags(df, key, day, date, name).drop("first_event")

    valid = seen(history.where(F.col("state").isin(*valid_states)), "contract", "snapshot", "valid")
    withdrawn = seen(withdrawals, "card", "withdrawn_on", "withdrawn")
    used = p.day_of("used_at")
    per_card = uses.groupBy("card").agg(
        F.min(used).alias("first_used"),
        *[
            F.max(column).alias(name)
            for name, column in zip(
                p.flag_names("active"), f.rolling_columns(used, date, "active"), strict=True
            )
        ],
    )
    activated = per_card.select(
        "*", *f.closed_by_columns(F.col("first_used"), date, "activated")
    ).drop("first_used")
    out = f.in_period_flags(contracts, "subscribed_on", date, "subscribed")
    out = out.join(valid, "contract", "left").join(withdrawn, "card", "left").join(activated, "card", "left")
    return f.fill_flags(out, PRODUCT_FLAGS)


def card_transactions(
    authorizations: DataFrame,
    routes: dict[str, Column],
    dimensions: Sequence[Dimension],
    cards: DataFrame,
) -> DataFrame:
    """Card transactions with their route, labels and the card's first use.

    ``authorizations(card, used_at, ...)``; ``cards(card, issued_on)``.  The routes
    exclude each other, so one labelled pass over the authorizations replaces one
    pass per route.  ``first_used`` is given for cards that are known.
    """
    routed = star_enrich(route(authorizations, routes), dimensions)
    first = routed.groupBy("card").agg(F.min("used_at").alias("first_used"))
    out = attach(routed, first, "card").join(cards, "card", "left")
    return out.withColumn("first_used", F.when(F.col("issued_on").isNotNull(), F.col("first_used")))


def direct_debits(
    contracts: DataFrame,
    movements: DataFrame,
    types: DataFrame,
    codes: DataFrame,
    billing: DataFrame,
    non_bank_types: DataFrame,
    date: DateLike,
    valid_states: Sequence[str],
    valid_until_due: Sequence[str] = (),
    billing_rules: dict[tuple[str, str], str] | None = None,
    unbilled: str = "NP",
) -> DataFrame:
    """Debits on contracts, with decoded states and the billing type.

    ``contracts(contract, external, kind, state, due_on)``, ``movements(contract,
    external, account, operation, reason, amount)`` in hundredths, ``types(kind,
    label, dfval)``, ``codes(keyword, code, decoded, dfval)``, ``billing(kind,
    billing, dfval)``, ``non_bank_types(kind)``.

    ``billing_rules`` maps (kind, operation) to a billing type that overrides the
    table; movements billed as ``unbilled``, or with no billing type, are left out.
    Whether a code table is broadcast is Spark's choice by its measured size.
    """
    state = F.col("state")
    in_force = state.isin(*valid_states) | (
        state.isin(*valid_until_due) & (p.day_of("due_on") > p.date_lit(date))
    )
    marked = contracts.withColumn(
        "validity", F.when(in_force, "VALID").otherwise("NOT VALID")
    )
    current_types = valid_at(types, date).select("kind", "label").distinct()
    labels = valid_at(codes, date).where(F.col("keyword") == "state").select(
        F.col("code").alias("state"), F.col("decoded").alias("state_label")
    ).distinct()
    billed = valid_at(billing, date).select("kind", "billing").distinct()
    others = non_bank_types.select("kind", F.lit("non-bank").alias("category")).distinct()
    joined = (
        movements.join(marked, ["contract", "external"])
        .join(current_types, "kind")
        .join(labels, "state")
        .join(billed, "kind", "left")
        .join(others, "kind", "left")
    )
    chosen = F.col("billing")
    for (kind, operation), value in (billing_rules or {}).items():
        rule = (F.col("kind") == kind) & (F.col("operation") == operation)
        chosen = F.when(rule, F.lit(value)).otherwise(chosen)
    return joined.withColumns(
        {
            "billing": chosen,
            "amount": F.col("amount") / 100,
            "category": F.coalesce("category", F.lit("bank")),
        }
    ).where(F.col("billing") != unbilled)
