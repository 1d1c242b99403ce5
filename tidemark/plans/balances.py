"""Balances: the fact table, commercial KPIs, positions and loan production."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import keys as k
from tidemark.functions import money as fm
from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators import comparison as c
from tidemark.operators import flags, money, objectives
from tidemark.operators.business_days import previous_business_day
from tidemark.sources import snapshots

BALANCE_PERIODS = (
    ("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2),
)


def balance_fact(
    balances: DataFrame,
    rates: DataFrame,
    mapping: DataFrame,
    date: DateLike,
    home: str,
    wire_kind: str,
    labels: tuple[str, str],
    dates: DataFrame | None = None,
) -> DataFrame:
    """Balances of one day in home currency, netted and classified, next to their
    earlier values.

    ``balances(account, currency, kind, class, day, debit, credit)``, one row per
    account, currency and day; ``rates(currency, quote_date, mid, low, high)``;
    ``mapping(class, side)``; ``labels`` are the texts for a loan and for a resource.

    The dates compared with are found first, from ``dates`` (one row per snapshot, see
    ``catalog_dates``) or the balances' own days; then only those days are read, once, and
    converted.  "``n`` days back" is the table's ``n``-th snapshot before the date, and an
    account without a balance on a date has null there.

    A mixed account gives two rows, one as a resource without debits and one as a
    loan without credits; this is an explode and not a union of filtered copies.
    """
    known = snapshots.snapshot_dates(balances, "day") if dates is None else dates
    calendar = snapshots.comparison_dates(known, date, periods=BALANCE_PERIODS, col="day")
    converted = money.convert_amounts(
        snapshots.on_calendar(balances, date, calendar, "day"), rates, ["debit", "credit"],
        home=home, wire_kind=wire_kind, on_date="day", spread_by=["account", "day"],
    )
    home_cols = ["debit_home", "credit_home"]
    today = c.values_on_dates(
        converted, home_cols, date, calendar, ["account", "currency"], "day"
    )
    sides = mapping.select("class", "side").distinct()
    fact = today.join(sides, "class", "left")
    debits = ["debit"] + [col for col in fact.columns if col.endswith("debit_home")]
    pairs = [(d, d.replace("debit", "credit")) for d in debits]
    labelled = money.classify_balances(fact, pairs, "side", labels)
    mixed = F.col("side") == fm.MIXED
    categories = F.when(mixed, F.array(F.lit(labels[1]), F.lit(labels[0]))).otherwise(
        F.array("category")
    )
    split = labelled.withColumn("category", F.explode(categories))
    loan, resource = (mixed & (F.col("category") == label) for label in labels)
    return split.withColumns(
        {
            **{d: F.when(~F.coalesce(resource, F.lit(False)), F.col(d)) for d, _ in pairs},
            **{cr: F.when(~F.coalesce(loan, F.lit(False)), F.col(cr)) for _, cr in pairs},
        }
    )


def commercial_report(
    daily: DataFrame,
    targets: DataFrame,
    season: DataFrame,
    date: DateLike,
    unit: str,
    product: str = "product",
    measure: str = "amount",
) -> DataFrame:
    """Variations of a day's measures and attainment of their objectives.

    ``daily(unit, product, day, measure)``, one row per unit, product and day;
    ``targets(unit, product, annual)``; ``season(year, week, pct_week, pct_cum,
    pct_quarter)``.
    """
    day = p.as_date(date)
    kpis = c.variation_kpis(
        daily.where(p.day_of("day") <= p.date_lit(day)), measure, day, [unit, product], "day",
        has_delta=False,
    ).where(p.day_of("day") == p.date_lit(day))
    dated = kpis.withColumns({"year": F.year("day"), "week": F.weekofyear("day")})
    return objectives.attainment(
        dated, targets, season, unit, product,
        f"variation_year_{measure}", f"variation_quarter_{measure}",
    )


def position_report(
    positions: DataFrame, securities: DataFrame, quotes: DataFrame, date: DateLike
) -> DataFrame:
    """Value of each holding on a day and at the ends of earlier periods; 0 where
    there was none.

    As :func:`money.value_positions`, with the column ``day`` in positions and
    quotes; ``securities`` is the same for all days.
    """
    days = quotes.select("day").distinct()
    per_day = money.latest_prices(securities.join(quotes, "isin"), ["security", "day"])
    held = positions.join(days, "day", "left_semi").groupBy("account", "security", "day").agg(
        F.sum("quantity").alias("quantity")
    )
    valued = held.join(per_day, ["security", "day"]).where("quantity > 0 AND price > 0").select(
        "account", "security", "day", F.round(F.col("quantity") * F.col("price"), 2).alias("value")
    )
    periods = [("week", 1), ("week", 2), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1)]
    now = c.values_as_of(valued, "value", date, periods, ["account", "security"], "day")
    return now.where("value IS NOT NULL").fillna(0)


def loan_production(
    disbursements: DataFrame,
    outstanding: DataFrame,
    holidays: DataFrame,
    date: DateLike,
    name: str = "production",
) -> DataFrame:
    """New loans net of what the account owed on the business day before.

    ``disbursements(loan, account, family, source, paid_on, amount)``,
    ``outstanding(account, family, day, debit)``; adds the previous business day,
    the net amount, the period flags of the payment and surrogate keys.
    """
    dated = previous_business_day(disbursements, holidays, "paid_on", back=1)
    owed = outstanding.groupBy("account", "family", p.day_of("day").alias("business_day")).agg(
        F.sum("debit").alias("owed")
    )
    joined = dated.join(owed, ["account", "family", "business_day"], "left")
    net = F.col("amount") - F.coalesce(F.col("owed"), F.lit(0))
    flagged = flags.in_period_flags(joined.withColumn("net_amount", net), "paid_on", date, name)
    return flagged.withColumns(
        {
            "loan_key": F.concat_ws("", "loan", "source"),
            "product_key": k.surrogate_key("family", "source", sep=""),
        }
    )


def equipment_objectives(
    objectives_wide: DataFrame, season: DataFrame, ids: Sequence[str], year: str = "year"
) -> DataFrame:
    """Weekly, monthly and quarterly objectives of every product column.

    Products become rows first, so a new product needs no new code and no wider
    plan.
    """
    long = objectives.unpivot_objectives(objectives_wide, ids).where("annual IS NOT NULL")
    return objectives.seasonal_split(long, season, year=year)
