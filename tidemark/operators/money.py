"""Netting, classification, conversion and flows of amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import money as m
from tidemark.functions import periods as p
from tidemark.functions.periods import DateLike
from tidemark.operators.densify import expected_dates, fill_nulls_bidirectional
from tidemark.operators.joins import as_list, spread_key
from tidemark.operators.segments import HOT_ROWS, nearest_known

# --- netting and classification --------------------------------------------------


def net_by_side(df: DataFrame, debit: str, credit: str, side: str) -> DataFrame:
    """Net debit and credit in place, as the mapping side of the account says."""
    d, c, s = F.col(debit), F.col(credit), F.col(side)
    return df.withColumns({debit: m.net_debit(d, c, s), credit: m.net_credit(d, c, s)})


def classify_balances(
    df: DataFrame,
    pairs: Sequence[tuple[str, str]],
    side: str,
    labels: tuple[str, str],
    label: str = "category",
) -> DataFrame:
    """Net several (debit, credit) pairs and label the row as loan or resource.

    ``labels`` are the texts for a loan and for a resource.  The label looks at the first pair after netting.
    """
    out = df
    for debit, credit in pairs:
        out = net_by_side(out, debit, credit, side)
    debit, credit = pairs[0]
    return out.withColumn(label, m.side_label(F.col(debit), F.col(credit), F.col(side), *labels))


def classify_prefix(
    df: DataFrame,
    ids: Sequence[str],
    credit_line: str,
    debit_line: str,
    classes: dict[str, str],
    default: str,
    categories: tuple[str, str],
) -> DataFrame:
    """Class of each line by its prefix; ``categories`` label credit and debit lines.

    One pass: a row yields up to two lines; distinct lines are kept.
    """
    lines = F.array(
        F.struct(F.col(credit_line).alias("line"), F.lit(categories[0]).alias("category")),
        F.struct(F.col(debit_line).alias("line"), F.lit(categories[1]).alias("category")),
    )
    split = df.select(*ids, F.inline(lines)).where(F.col("line").isNotNull()).distinct()
    return split.select("*", m.prefix_class(F.col("line"), classes, default).alias("class"))


# --- rates ------------------------------------------------------------------------


def unit_rates(
    df: DataFrame,
    mid: str | None = None,
    sell: str | None = None,
    buy: str | None = None,
    unit: str = "unit",
    note_rate=m.note_rate_per_unit,
    name: str = "rate",
) -> DataFrame:
    """Rate of one currency unit from a mid quote, or from note quotes."""
    per_unit = F.col(unit)
    if mid is not None:
        return df.withColumn(name, m.mid_per_unit(F.col(mid), per_unit))
    return df.withColumn(name, note_rate(F.col(sell), F.col(buy), per_unit))


def _wire_quotes(wire: DataFrame) -> DataFrame:
    return wire.select(
        F.col("currency").alias("__wire"),
        F.col("quote_date").alias("__wire_date"),
        m.mid_per_unit(F.col("mid"), F.col("unit")).alias("mid"),
    )


def _cash_quotes(cash: DataFrame) -> DataFrame:
    return cash.select(
        F.col("currency").alias("__cash"),
        F.col("quote_date").alias("__cash_date"),
        m.mid_per_unit(F.col("buy"), F.col("unit")).alias("low"),
        m.mid_per_unit(F.col("sell"), F.col("unit")).alias("high"),
    )


def rate_table(currencies: DataFrame, wire: DataFrame, cash: DataFrame) -> DataFrame:
    """Every reference currency with its wire and note rates per unit, if any.

    ``currencies(currency, ...)``, ``wire(currency, mid, unit, quote_date)``,
    ``cash(currency, sell, buy, unit, quote_date)``.
    """
    w, c = _wire_quotes(wire), _cash_quotes(cash)
    joined = currencies.join(w, currencies["currency"] == w["__wire"], "left").join(
        c, currencies["currency"] == c["__cash"], "left"
    )
    return joined.select(
        *currencies.columns,
        F.coalesce("__wire_date", "__cash_date").alias("quote_date"),
        "mid", "low", "high",
    )


def rate_history(currencies: DataFrame, wire: DataFrame, cash: DataFrame) -> DataFrame:
    """Wire and note rates per unit by currency and day."""
    w, c = _wire_quotes(wire), _cash_quotes(cash)
    same = (w["__wire"] == c["__cash"]) & (w["__wire_date"] == c["__cash_date"])
    quoted = w.join(c, same, "left").select(
        F.col("__wire").alias("currency"), F.col("__wire_date").alias("quote_date"),
        "mid", "low", "high",
    )
    return quoted.join(currencies, "currency", "left")


def tagged_rates(wire: DataFrame, cash: DataFrame, tags: tuple[str, str]) -> DataFrame:
    """The distinct quotes of both files in one table with a type tag."""
    both = wire.withColumn("quote_type", F.lit(tags[0])).unionByName(
        cash.withColumn("quote_type", F.lit(tags[1]))
    )
    return both.distinct()


def convert_amounts(
    df: DataFrame,
    rates: DataFrame,
    amounts: Sequence[str],
    *,
    home: str,
    wire_kind: str,
    currency: str = "currency",
    kind: str = "kind",
    on_date: str | None = None,
    suffix: str = "_home",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Amounts in home currency: wire rows at the mid rate, others at the midpoint
    of the note quotes, home-currency rows as they are.

    ``rates`` has ``currency, mid, low, high`` (and ``quote_date`` when
    ``on_date`` names the amount's date column).  Rows in home currency, usually the
    most, need no rate and never join: their key is a hash of ``spread_by`` (all
    columns by default), so that they spread over all tasks.  Whether the rates are
    broadcast is Spark's choice by their measured size and changes no row.
    """
    is_home = F.col(currency) == home
    keyed = df.withColumn("__currency", spread_key(df, currency, is_home, spread_by))
    quotes = rates.select(
        F.col("currency").alias("__quoted"),
        *([F.col("quote_date").alias("__quote_date")] if on_date else []),
        F.col("mid").alias("__mid"),
        m.note_average(F.col("low"), F.col("high")).alias("__note"),
    )
    match = keyed["__currency"] == quotes["__quoted"]
    if on_date:
        match = match & (p.day_of(keyed[on_date]) == quotes["__quote_date"])
    rate = (
        F.when(is_home, F.lit(1))
        .when(F.col(kind) == wire_kind, F.col("__mid"))
        .otherwise(F.col("__note"))
    )
    return keyed.join(quotes, match, "left").select(
        *df.columns,
        *[(F.col(a) * rate).cast(m.AMOUNT).alias(a + suffix) for a in amounts],
    )


def convert_amounts_asof(
    df: DataFrame,
    rates: DataFrame,
    amounts: Sequence[str],
    *,
    home: str,
    wire_kind: str,
    on_date: str,
    currency: str = "currency",
    kind: str = "kind",
    suffix: str = "_home",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """As ``convert_amounts`` at filled daily rates, without filling: each amount takes the
    rate of its day, else the next known one, else the last known before.

    Amounts and quotes are one stream by currency and day, so no row is made for a currency
    and day without an amount.  A currency with many amounts is cut into ranges of days.
    Rows in home currency are not part of the stream.
    """
    is_home = F.coalesce(F.col(currency) == home, F.lit(False))
    named = df.withColumn("__on", p.day_of(on_date)).withColumn("__of", F.col(currency))
    quotes = rates.select(
        F.col("currency").alias("__of"), F.col("quote_date").alias("__on"), *[F.col(c).alias(f"__{c}") for c in ("mid", "low", "high")]
    )
    known = nearest_known(named.where(~is_home), quotes, "__of", "__on", ["__mid", "__low", "__high"], hot_rows=hot_rows)
    note = m.note_average(F.col("__low"), F.col("__high"))
    rate = F.when(F.col(kind) == wire_kind, F.col("__mid")).otherwise(note)
    at = lambda rows, r: rows.select(*df.columns, *[(F.col(a) * r).cast(m.AMOUNT).alias(a + suffix) for a in amounts])
    return at(df.where(is_home), F.lit(1)).unionByName(at(known, rate))


def fill_rates(rates: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Rates of every currency on every day from ``start`` to ``end``; gaps are
    filled from the next known day, else from the previous one.

    Each currency is expanded along the calendar, so the result is bounded by
    currencies times days.  Quotes outside the span still fill gaps inside it.
    """
    days = F.sequence(p.date_lit(start), p.date_lit(end))
    spine = rates.select("currency").distinct().select(
        "currency", F.explode(days).alias("quote_date")
    )
    full = spine.join(rates, ["currency", "quote_date"], "full")
    return fill_nulls_bidirectional(full, ["mid", "low", "high"], "currency", "quote_date")


# --- flows ------------------------------------------------------------------------


def _credits_by_day(
    movements: DataFrame, account: str, date: str, currency: str, amount: str, side: str
) -> DataFrame:
    """Credit movements summed per account, day and currency, before any join."""
    return (
        movements.where(F.col(side) == "C")
        .groupBy(
            F.col(account).alias("account"),
            p.day_of(date).alias("day"),
            F.trim(currency).alias("currency"),
        )
        .agg(F.sum(amount).alias("total"), F.max(amount).alias("largest"))
    )


def _at_rate(flows: DataFrame, rates: DataFrame, home: str) -> DataFrame:
    """Attach ``rate / 100`` of the day and currency as ``__rate``; home rows do not join."""
    quotes = rates.select(
        F.trim("currency").alias("__currency"), F.col("quote_date").alias("__day"), "mid"
    )
    is_home = F.col("currency") == home
    keyed = flows.withColumn("__key", spread_key(flows, "currency", is_home))
    match = (keyed["__key"] == quotes["__currency"]) & (keyed["day"] == quotes["__day"])
    rate = F.when(is_home, F.lit(1)).otherwise(F.col("mid")) / F.lit(100)
    return keyed.join(quotes, match, "left").select(
        *flows.columns, rate.alias("__rate")
    )


def credit_flow(
    movements: DataFrame,
    rates: DataFrame,
    account: str,
    date: str,
    currency: str,
    amount: str,
    side: str,
    home: str,
) -> DataFrame:
    """Credit movements per account in home currency; amounts are in hundredths and
    an unknown rate counts as 0."""
    flows = _at_rate(
        _credits_by_day(movements, account, date, currency, amount, side), rates, home
    )
    converted = F.coalesce(F.col("total") * F.col("__rate"), F.lit(0))
    return flows.groupBy("account").agg(F.sum(converted).alias("credit_flow"))


def monthly_flow_flags(
    movements: DataFrame,
    rates: DataFrame,
    reference: DateLike,
    account: str,
    date: str,
    currency: str,
    amount: str,
    side: str,
    home: str,
    threshold: int = 2000,
) -> DataFrame:
    """Per account: total of the month, and for this month and the two before a 0/1
    flag that some movement reached the threshold."""
    span = p.Bounds(p.period_bounds(reference, "month", 2).start, p.period_end(reference, "month"))
    recent = movements.where(p.within(p.day_of(date), span))
    flows = _at_rate(_credits_by_day(recent, account, date, currency, amount, side), rates, home)
    months = [p.within(F.col("day"), p.period_bounds(reference, "month", n)) for n in range(3)]
    reached = F.col("largest") * F.col("__rate") >= threshold
    total = F.when(months[0], F.coalesce(F.col("total") * F.col("__rate"), F.lit(0)))
    return flows.groupBy("account").agg(
        F.sum(total.otherwise(F.lit(0))).alias("month_total"),
        *[
            F.max(F.coalesce(month & reached, F.lit(False)).cast("int")).alias(f"flag_m_{n}")
            for n, month in enumerate(months)
        ],
    )


def since_bounds(date: DateLike) -> dict[str, object]:
    """Starts of the running and earlier periods: this and last week, this month
    and the two before, this and last quarter, this year, last quarter of last
    year."""
    year = p.period_start(date, "year")
    return {
        "s": p.period_start(date, "week"),
        "s_1": p.period_bounds(date, "week", 1).start,
        "m": p.period_start(date, "month"),
        "m_1": p.period_bounds(date, "month", 1).start,
        "m_2": p.period_bounds(date, "month", 2).start,
        "t": p.period_start(date, "quarter"),
        "t_1": p.period_bounds(p.period_start(date, "quarter"), "quarter", 1).start,
        "y": year,
        "y_1": p.period_bounds(year, "quarter", 1).start,
    }


def sums_since(
    df: DataFrame, keys: str | Sequence[str], date: str, amount: Column, bounds: dict
) -> DataFrame:
    """Per key, the sum of ``amount`` on or after each bound."""
    day = p.day_of(date)
    return df.groupBy(*as_list(keys)).agg(
        *[
            F.sum(F.when(day >= p.date_lit(start), amount).otherwise(F.lit(0))).alias(f"sum_{name}")
            for name, start in bounds.items()
        ]
    )


def roll_up(df: DataFrame, links: DataFrame, on: str, keys: str | Sequence[str]) -> DataFrame:
    """Sums per account as sums per owner; owners without movements have nulls."""
    sums = [c for c in df.columns if c != on]
    return links.join(df, on, "left").groupBy(*as_list(keys)).agg(*[F.sum(c).alias(c) for c in sums])


# --- monthly balances ----------------------------------------------------------------


def _nonzero(cols: Sequence[str]) -> Column:
    any_value = F.lit(False)
    for c in cols:
        any_value = any_value | F.coalesce(F.col(c) != 0, F.lit(False))
    return any_value


def monthly_balance(
    df: DataFrame,
    keys: Sequence[str],
    classes: Sequence[str],
    date: str,
    amounts: Sequence[str],
) -> DataFrame:
    """Monthly sums per key and class, with the number of rows the key has in the
    month; rows whose sums are all null or 0 are dropped.

    The row count is carried through the first aggregation and summed over the
    few classes of a key and month, so the balances are shuffled once.
    """
    month = F.date_format(p.day_of(date), "yyyyMM").alias("month")
    sums = df.groupBy(*keys, month, *classes).agg(
        *[F.sum(a).alias(f"{a}_monthly") for a in amounts], F.count("*").alias("__rows")
    )
    occurrences = F.sum("__rows").over(Window.partitionBy(*keys, "month"))
    counted = sums.withColumn("occurrences", occurrences).drop("__rows")
    return counted.where(_nonzero([f"{a}_monthly" for a in amounts]))


def monthly_balance_dense(
    df: DataFrame,
    reference: DateLike,
    keys: Sequence[str],
    classes: Sequence[str],
    date: str,
    amounts: Sequence[str],
) -> DataFrame:
    """Monthly sums in which every calendar day of the year up to ``reference``
    counts, days without a snapshot with the one before.

    A snapshot is weighted by the number of days it stands for in a month instead
    of being copied once per day, so no row is multiplied.  ``occurrences`` is the
    number of days in the month.  Rows on days that stand for none are summed
    under a null month.
    """
    expected = expected_dates(df, reference, date)
    weights = (
        expected.where(F.col("actual_date").isNotNull())
        .groupBy(
            F.col("actual_date").alias("__day"),
            F.date_format("expected_date", "yyyyMM").alias("month"),
        )
        .agg(F.count("*").alias("__days"), F.max("expected_date").alias("__in_month"))
    )
    per_day = df.groupBy(*keys, *classes, p.day_of(date).alias("__on")).agg(
        *[F.sum(a).alias(a) for a in amounts]
    )
    # at most one row per day of the year and month: safe to broadcast
    weights = F.broadcast(weights)
    weighted = per_day.join(weights, per_day["__on"] == weights["__day"], "left")
    days = F.coalesce(F.col("__days"), F.lit(1))
    return (
        weighted.groupBy(*keys, "month", *classes)
        .agg(
            *[F.sum(F.col(a) * days).alias(f"{a}_monthly") for a in amounts],
            F.max(F.dayofmonth(F.last_day("__in_month"))).alias("occurrences"),
        )
    )


# --- positions -------------------------------------------------------------------------


def latest_prices(quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The price of each key's latest ``quote_date``, the highest if there are several.

    Two hash aggregations: the first spreads a key with many quotes over its days,
    and neither has to sort, as one with a compound order would.
    """
    daily = quotes.groupBy(*keys, "quote_date").agg(F.max("price").alias("price"))
    return daily.groupBy(*keys).agg(F.max_by("price", "quote_date").alias("price"))


def value_positions(
    positions: DataFrame,
    securities: DataFrame,
    quotes: DataFrame,
    account: str,
    snapshot: str | None = None,
    priced_at_zero: Sequence[str] = (),
) -> DataFrame:
    """Holdings times the latest quote.

    ``positions(account, security, quantity)``, ``securities(security, isin)``,
    ``quotes(isin, quote_date, price)``, each with the ``snapshot`` column too when
    it is given.  Of several quotes on the latest day, and of several codes per
    security, the highest price counts.  Only positive holdings and prices are
    valued; the value is rounded to 2 decimals.
    """
    on = [snapshot] if snapshot else []
    price = F.when(F.col("isin").isin(*priced_at_zero), F.lit(0)).otherwise(F.col("price"))
    latest = latest_prices(quotes, ["isin", *on])
    per_security = (
        securities.join(latest, ["isin", *on]).groupBy("security", *on).agg(F.max(price).alias("price"))
    )
    held = positions.groupBy(account, "security", *on).agg(F.sum("quantity").alias("quantity"))
    valued = held.join(per_security, ["security", *on]).where("quantity > 0 AND price > 0")
    return valued.withColumn("value", F.round(F.col("quantity") * F.col("price"), 2))
