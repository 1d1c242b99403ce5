"""The account dimension and the use of digital channels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys as k
from tidemark.functions.periods import DateLike
from tidemark.operators import flags
from tidemark.operators.comparison import decode_codes
from tidemark.operators.latest import latest_by, valid_at
from tidemark.operators.shaping import fill_unknown, full_outer_rules, unmatched_rows


def account_dimension(
    accounts: DataFrame,
    holders: DataFrame,
    disputes: DataFrame,
    portfolios: DataFrame,
    currencies: DataFrame,
    balances: DataFrame,
    date: DateLike,
) -> DataFrame:
    """Accounts with their keys, and those that only the balances know.

    ``accounts(account, currency, element)``, ``holders(element, customer)``,
    ``disputes(account, portfolio, place, modified)``, ``portfolios(customer, portfolio,
    place)``, ``currencies(currency, code, dfval)``, ``balances(account, code)``.

    An account belongs to the portfolio of its latest dispute, else to its customer's.
    Accounts of the balances that are not in ``accounts`` get a row with unknown
    members, so that facts always find their account.
    """
    disputed = latest_by(disputes, "account", "modified", ties=["portfolio", "place"]).select(
        "account", k.surrogate_key("portfolio", "place").alias("dispute_key")
    )
    owned = portfolios.select("customer", k.surrogate_key("portfolio", "place").alias("customer_key"))
    codes = valid_at(currencies, date).select("currency", "code").distinct()
    known = (
        accounts.join(disputed, "account", "left")
        .join(holders, "element", "left")
        .join(owned, "customer", "left")
        .join(codes, "currency", "left")
        .select(
            "account", "code", "customer", "element",
            F.col("dispute_key"),
            F.coalesce("dispute_key", "customer_key").alias("portfolio_key"),
            F.lit("origin").alias("kind"),
        )
    )
    only_balances = unmatched_rows(
        balances.select("account", "code").distinct(), [(known, {"account": "account", "code": "code"})]
    ).withColumn("kind", F.lit("-1"))
    everything = known.unionByName(only_balances, allowMissingColumns=True)
    keyed = everything.withColumn(
        "account_key", F.concat_ws("", "account", F.coalesce("code", F.lit("0")))
    )
    return fill_unknown(keyed)


def digital_usage(
    customers: DataFrame,
    contracts: DataFrame,
    relations: DataFrame,
    users: DataFrame,
    events: DataFrame,
    option_position: int,
    options: dict[str, Sequence[str]],
    products: Sequence[str],
    always: Sequence[str] = (),
) -> DataFrame:
    """Customers with their digital access and how often they connected.

    ``customers(customer)``, ``contracts(customer, product, details)`` where one
    character of ``details`` is the access option, ``relations(customer, related)``,
    ``users(customer, user)``, ``events(user, ts, snapshot)``.

    ``options`` maps a label to its option characters.  A customer has access with a
    contract that has a listed option, with any contract of the products in
    ``always``, or as a related party.
    """
    option = F.nullif(F.substring("details", option_position, 1), F.lit(" "))
    held = contracts.where(F.col("product").isin(*products, *always)).select(
        "customer", "product", option.alias("option")
    ).distinct()
    listed = F.col("option").isin(*[code for codes in options.values() for code in codes])
    access = full_outer_rules(
        held, relations.distinct(), "customer",
        listed, F.col("product").isin(*always), F.col("related"),
    ).select(
        "customer", "option", decode_codes(F.col("option"), options).alias("access")
    ).distinct()
    counts = flags.event_counts(events, "user", "ts", "snapshot")
    per_customer = counts.join(users, "user").drop("user")
    joined = customers.join(access.withColumn("__has", F.lit(1)), "customer", "left").join(
        per_customer, "customer", "left"
    )
    return joined.withColumn("is_digital", F.coalesce("__has", F.lit(0))).drop("__has").fillna(
        0, ["events_day", "events_week", "events_month"]
    )
