"""Customer equipment: what each holder has, in which state, and whether it is used."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import periods as p
from tidemark.operators import comparison as c
from tidemark.operators import flags as f
from tidemark.operators.joins import attach


def _last_use(events: DataFrame, key: str, name: str) -> DataFrame:
    return events.groupBy(key).agg(F.max(p.day_of("day")).alias(name))


def customer_equipment(
    contracts: DataFrame,
    history: DataFrame,
    holders: DataFrame,
    branches: DataFrame,
    card_use: DataFrame,
    connections: DataFrame,
    families: Mapping[str, Sequence[str]],
    valid: str,
    days: int = 90,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per contract and snapshot day of the products in ``families``, next to its
    holder, the holder's branch, its state in the previous observed week, month and year,
    and flags: valid, card and digital use within ``days`` of the snapshot, sold in the
    snapshot's week, month and year.

    ``contracts(contract, holder, product, state, since, day)``; ``history(contract, state,
    day)``, one row per contract and day; ``holders(holder, branch, ...)``;
    ``branches(branch, ...)``; ``card_use(contract, day)``; ``connections(holder, day)``.
    ``families`` maps a family to its product codes.  Contracts without a holder, branch or
    use stay.

    Uses are reduced to the last day of a contract or holder before they are joined.
    ``hot_rows`` is that of :func:`comparison.prev_observed_state`.
    """
    family = F.lit(None).cast("string")
    for name, products in families.items():
        family = F.when(F.col("product").isin(*products), name).otherwise(family)
    held = contracts.distinct().withColumn("family", family).where(F.col("family").isNotNull())
    units = ["week", "month", "year"]
    before = c.prev_observed_state(history.select("contract", "state", "day"), "state", units, "contract", "day", hot_rows=hot_rows)
    out = attach(held, before.drop("state"), ["contract", "day"])
    out = out.join(holders, "holder", "left").join(branches, "branch", "left")
    out = out.join(_last_use(card_use, "contract", "last_card_use"), "contract", "left")
    out = out.join(_last_use(connections, "holder", "last_connection"), "holder", "left")
    is_valid = F.coalesce(F.col("state") == valid, F.lit(False))
    at = p.day_of("day")
    marked = out.select(
        "*",
        is_valid.cast("int").alias("is_valid"),
        f.recency_column("last_card_use", days, at).cast("int").alias("card_active"),
        f.recency_column("last_connection", days, at).cast("int").alias("digital_active"),
    )
    return f.sold_flags(marked, "since", "day", is_valid, F.col("family").isNotNull())
