"""The ten period flags on order and event dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import EVENT_REF, REF, Tables, literal_rows, query, values_sql
from tidemark.functions import periods as p
from tidemark.operators import business_days as b
from tidemark.operators import flags as f

MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _moved(ref: str, unit: str, n: int) -> str:
    span = f"{7 * n} DAY" if unit == "week" else f"{MONTHS[unit] * n} MONTH"
    return f"CAST(DATE '{ref}' - INTERVAL {span} AS DATE)"


def _close(ref: str, unit: str, n: int) -> str:
    if n == 0:
        return f"DATE '{ref}'"
    start = f"date_trunc('{unit}', {_moved(ref, unit, n)})"
    span = "7 DAY" if unit == "week" else f"{MONTHS[unit]} MONTH"
    return f"CAST({start} + INTERVAL {span} - INTERVAL 1 DAY AS DATE)"


def flags_sql(name: str, predicate, wrap: str = "CAST({} AS INT)") -> str:
    """The ten flag columns for a predicate ``(unit, n) -> SQL``."""
    return ",\n".join(
        wrap.format(predicate(unit, n)) + f" AS is_{name}_{suffix}"
        for suffix, unit, n in p.FLAG_PERIODS
    )


def in_period(day: str, ref: str):
    return lambda unit, n: (
        f"date_trunc('{unit}', {day}) = date_trunc('{unit}', {_moved(ref, unit, n)})"
    )


def closed_by(day: str, ref: str):
    return lambda unit, n: f"{day} <= {_close(ref, unit, n)}"


def active_at(start: str, end: str, ref: str):
    return lambda unit, n: (
        f"{start} <= {_close(ref, unit, n)} AND {end} > {_close(ref, unit, n)}"
    )


def months_between_sql(later: str, earlier: str) -> str:
    """Whole months when both are on the same day of the month or both on its last
    day, else the month difference plus the day difference in 31sts."""
    whole = f"(year({later}) - year({earlier})) * 12 + month({later}) - month({earlier})"
    same = (
        f"day({later}) = day({earlier}) OR"
        f" ({later} = last_day({later}) AND {earlier} = last_day({earlier}))"
    )
    return f"({whole} + CASE WHEN {same} THEN 0.0 ELSE (day({later}) - day({earlier})) / 31.0 END)"


def rolling(day: str, ref: str):
    return lambda unit, n: (
        f"{months_between_sql(_close(ref, unit, n), day)} BETWEEN 0 AND 3"
    )


ORDER_DAY = "CAST(o_orderdate AS DATE)"
EVENT_DAY = "CAST(ts AS DATE)"


@query("flags_in_period", f"SELECT o_orderkey, {flags_sql('ordered', in_period(ORDER_DAY, REF))} FROM orders")
def flags_in_period(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return f.in_period_flags(orders, "o_orderdate", REF, "ordered").drop("o_orderdate")


def _by_number(unit: str, n: int) -> str:
    if unit != "week":
        return in_period(ORDER_DAY, "2001-01-03")(unit, n)
    moved = _moved("2001-01-03", unit, n)
    return f"year({ORDER_DAY}) = year({moved}) AND week({ORDER_DAY}) = week({moved})"


@query("flags_in_period_week_number", f"SELECT o_orderkey, {flags_sql('ordered', _by_number)} FROM orders")
def flags_in_period_week_number(t: Tables) -> DataFrame:
    """Around New Year, with weeks identified by calendar year and week number."""
    orders = t.orders.select("o_orderkey", "o_orderdate")
    flagged = f.in_period_flags(orders, "o_orderdate", "2001-01-03", "ordered", "calendar_year")
    return flagged.drop("o_orderdate")


@query("flags_closed_by", f"SELECT o_orderkey, {flags_sql('ordered', closed_by(ORDER_DAY, REF))} FROM orders")
def flags_closed_by(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return f.closed_by_flags(orders, "o_orderdate", REF, "ordered").drop("o_orderdate")


@query(
    "flags_active_at_close",
    "SELECT l_orderkey, l_linenumber, "
    + flags_sql("open", active_at(ORDER_DAY, "CAST(l_shipdate AS DATE)", REF))
    + " FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)
def flags_active_at_close(t: Tables) -> DataFrame:
    """Line items that are ordered and not yet shipped at each close."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    dates = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    joined = lines.join(dates, "l_orderkey")
    return f.active_at_flags(joined, "o_orderdate", "l_shipdate", REF, "open").drop(
        "o_orderdate", "l_shipdate"
    )


@query("flags_rolling_activity", f"SELECT o_orderkey, {flags_sql('active', rolling(ORDER_DAY, REF))} FROM orders")
def flags_rolling_activity(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_orderdate")
    return f.rolling_activity_flags(orders, "o_orderdate", REF, "active").drop("o_orderdate")


@query(
    "flags_rollup",
    "SELECT o_custkey, "
    + flags_sql("active", rolling(ORDER_DAY, REF), "max(CAST({} AS INT))")
    + " FROM orders GROUP BY o_custkey",
)
def flags_rollup(t: Tables) -> DataFrame:
    flagged = f.rolling_activity_flags(t.orders, "o_orderdate", REF, "active")
    return f.rollup_flags(flagged, "o_custkey", "active")


@query(
    "flags_week_bounds",
    f"""SELECT o_orderkey, CAST(CAST(date_trunc('week', {ORDER_DAY}) AS DATE) AS VARCHAR) AS monday,
  CAST(CAST(date_trunc('week', {ORDER_DAY}) + INTERVAL 6 DAY AS DATE) AS VARCHAR) AS sunday FROM orders""",
)
def flags_week_bounds(t: Tables) -> DataFrame:
    day = p.day_of("o_orderdate")
    return t.orders.select(
        "o_orderkey", p.first_day_of_week(day).alias("monday"), p.last_day_of_week(day).alias("sunday")
    )


@query(
    "flags_first_event",
    f"""WITH firsts AS (SELECT user_id, MIN({EVENT_DAY}) AS day FROM events
  WHERE event_type = 'purchase' GROUP BY 1)
SELECT user_id, CAST(day AS VARCHAR) AS first_event, {flags_sql('activated', closed_by('day', EVENT_REF))} FROM firsts""",
)
def flags_first_event(t: Tables) -> DataFrame:
    purchases = t.events.where("event_type = 'purchase'")
    return f.first_event_flags(purchases, "user_id", "ts", EVENT_REF, "activated")


@query(
    "flags_recency",
    f"""SELECT user_id, CAST(MAX({EVENT_DAY}) AS VARCHAR) AS last_event,
  CAST(MAX({EVENT_DAY}) BETWEEN DATE '2024-01-30' - 1 AND DATE '2024-01-30' AS INT) AS is_active_1d,
  CAST(MAX({EVENT_DAY}) BETWEEN DATE '2024-01-30' - 7 AND DATE '2024-01-30' AS INT) AS is_active_7d
FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def flags_recency(t: Tables) -> DataFrame:
    purchases = t.events.where("event_type = 'purchase'")
    return f.active_within(purchases, "user_id", "ts", [1, 7], "2024-01-30")


@query(
    "events_by_period",
    """WITH e AS (SELECT user_id, ts, CAST(ts AS DATE) AS day,
    CAST(last_day(CAST(ts AS DATE)) AS DATE) AS snapshot FROM events WHERE event_type = 'click')
SELECT user_id, CAST(snapshot AS VARCHAR) AS snapshot,
  strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_event,
  COUNT(DISTINCT CASE WHEN day = snapshot THEN ts END) AS events_day,
  COUNT(DISTINCT CASE WHEN date_trunc('week', day) = date_trunc('week', snapshot) THEN ts END) AS events_week,
  COUNT(DISTINCT CASE WHEN date_trunc('month', day) = date_trunc('month', snapshot) THEN ts END) AS events_month
FROM e GROUP BY user_id, snapshot""",
)
def events_by_period(t: Tables) -> DataFrame:
    clicks = t.events.where("event_type = 'click'").withColumn(
        "snapshot", F.last_day(F.col("ts").cast("date"))
    )
    counts = f.event_counts(clicks, "user_id", "ts", "snapshot")
    return counts.withColumn("last_event", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss"))


@query(
    "flags_sold_in_period",
    """WITH s AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS day,
    CAST(CAST(l_shipdate AS DATE) AS DATE) AS snapshot, l_linenumber, l_partkey
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
v AS (SELECT *, o_orderstatus <> 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AS ok FROM s)
SELECT o_orderkey, l_linenumber, l_partkey,
  CAST(ok AND date_trunc('week', day) = date_trunc('week', snapshot) AS INT) AS is_weekly,
  CAST(ok AND date_trunc('month', day) = date_trunc('month', snapshot) AS INT) AS is_monthly,
  CAST(ok AND date_trunc('year', day) = date_trunc('year', snapshot) AS INT) AS is_yearly
FROM v""",
)
def flags_sold_in_period(t: Tables) -> DataFrame:
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_shipdate"
    )
    sold = f.sold_flags(
        t.orders.join(lines, "o_orderkey"), "o_orderdate", "l_shipdate",
        valid=F.col("o_orderstatus") != "F",
        family=F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
    )
    return sold.select("o_orderkey", "l_linenumber", "l_partkey", "is_weekly", "is_monthly", "is_yearly")


HOLIDAYS = [("2001-06-15",), ("2001-06-14",), ("2000-12-25",), ("1999-05-03",), ("1998-01-01",), ("1997-07-30",)]


@query(
    "business_day_previous",
    f"""WITH holidays(holiday) AS ({values_sql(HOLIDAYS)}),
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
found AS (
  SELECT day, MAX(c) AS business_day
  FROM (SELECT day, CAST(day - CAST(i AS INT) AS DATE) AS c FROM days, generate_series(1, 8) AS g(i)) AS t
  WHERE dayofweek(c) NOT IN (0, 6) AND CAST(c AS VARCHAR) NOT IN (SELECT holiday FROM holidays)
  GROUP BY day)
SELECT o_orderkey, CAST(day AS VARCHAR) AS day, CAST(business_day AS VARCHAR) AS business_day
FROM orders JOIN found ON day = CAST(o_orderdate AS DATE)""",
)
def business_day_previous(t: Tables) -> DataFrame:
    holidays = literal_rows(t.spark, "holiday string", HOLIDAYS)
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return b.previous_business_day(orders, holidays, "day", back=1)
