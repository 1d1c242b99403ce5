"""Window comparisons on daily order totals per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import ORACLES, REF, Tables, cents, fresh_folder, query
from tidemark.functions import periods as p
from tidemark.operators import carried as k
from tidemark.operators import comparison as c
from tidemark.operators import densify as d

KEYS = ["o_custkey"]

DAILY = """WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS amount
  FROM orders GROUP BY 1, 2)
"""
R = f"DATE '{REF}'"
IDS = "o_custkey, CAST(day AS VARCHAR) AS day, CAST(amount AS DOUBLE) AS amount"


def daily(t: Tables) -> DataFrame:
    return c.daily_totals(t.orders, KEYS, "o_orderdate", {"amount": cents("o_totalprice")})


def prev_sql(unit: str, n: int, col: str = "amount") -> str:
    """Running form: the value before a period change at the right distance."""
    distance = {
        "week": f"datediff('day', CAST(date_trunc('week', p_day) AS DATE), CAST(date_trunc('week', {R}) AS DATE)) = {7 * n}",
        "month": f"(year({R}) - year(p_day)) * 12 + month({R}) - month(p_day) = {n}",
        "year": f"year({R}) - year(p_day) = {n}",
    }[unit]
    return (
        f"last_value(CASE WHEN date_trunc('{unit}', day) <> date_trunc('{unit}', p_day) AND {distance}"
        f" THEN p_{col} END IGNORE NULLS) OVER run"
    )


LAGGED = DAILY + """, lagged AS (
  SELECT *, lag(day) OVER w AS p_day, lag(amount) OVER w AS p_amount
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
"""
RUN = """
FROM lagged WINDOW run AS (PARTITION BY o_custkey ORDER BY day
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
OBSERVED = "last_value(CASE WHEN date_trunc('{unit}', day) <> date_trunc('{unit}', p_day) THEN p_amount END IGNORE NULLS) OVER run"


@query(
    "win_lag_snapshots",
    DAILY + f"""SELECT {IDS}, CAST(lag(amount, 1) OVER w AS DOUBLE) AS last_day_amount,
       CAST(lag(amount, 3) OVER w AS DOUBLE) AS last_3_days_amount
FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""",
)
def win_lag_snapshots(t: Tables) -> DataFrame:
    one_back = c.lag_value(daily(t), "amount", 1, KEYS, "day")
    return c.lag_value(one_back, "amount", 3, KEYS, "day")


def _register_prev(unit: str, offsets: tuple[int, ...]) -> None:
    names = [c.past_name("amount", unit, n) for n in offsets]
    columns = ",\n".join(
        f"CAST({prev_sql(unit, n)} AS DOUBLE) AS {name}"
        for n, name in zip(offsets, names, strict=True)
    )

    @query(f"win_prev_{unit}", LAGGED + f"SELECT {IDS},\n{columns}{RUN}")
    def prev(t: Tables) -> DataFrame:
        periods = [(unit, n) for n in offsets]
        return c.prev_period_value(daily(t), "amount", REF, periods, KEYS, "day")


_register_prev("month", (1, 2, 12))
_register_prev("year", (1, 2))
_register_prev("week", (1, 2, 10))


@query(
    "win_prev_quarter_observed",
    LAGGED + f"SELECT {IDS}, CAST({OBSERVED.format(unit='quarter')} AS DOUBLE) AS last_quarter_amount{RUN}",
)
def win_prev_quarter_observed(t: Tables) -> DataFrame:
    return c.prev_observed_period_value(daily(t), "amount", "quarter", KEYS, "day")


@query(
    "win_prev_quarter_exact",
    DAILY + """, closes AS (
  SELECT o_custkey, CAST(date_trunc('quarter', day) AS DATE) AS q, arg_max(amount, day) AS amount
  FROM daily GROUP BY 1, 2)
SELECT daily.o_custkey, CAST(daily.day AS VARCHAR) AS day, CAST(daily.amount AS DOUBLE) AS amount,
       CAST(closes.amount AS DOUBLE) AS last_quarter_amount
FROM daily LEFT JOIN closes ON closes.o_custkey = daily.o_custkey
 AND closes.q = CAST(date_trunc('quarter', daily.day) - INTERVAL 3 MONTH AS DATE)""",
)
def win_prev_quarter_exact(t: Tables) -> DataFrame:
    return c.prev_observed_period_value(daily(t), "amount", "quarter", KEYS, "day", exact=True)


@query(
    "win_same_day_last_year",
    DAILY + f"""SELECT {IDS}, CAST(last_value(CASE WHEN day = CAST({R} - INTERVAL 12 MONTH AS DATE) THEN amount END
                   IGNORE NULLS) OVER run AS DOUBLE) AS same_day_last_year_amount
FROM daily WINDOW run AS (PARTITION BY o_custkey ORDER BY day
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_same_day_last_year(t: Tables) -> DataFrame:
    return c.same_day_last_year(daily(t), "amount", REF, KEYS, "day")


# --- balances: debit and credit sides of the line items of a supplier -----------------

SIDES = """WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day,
         SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS debit,
         SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS credit
  FROM lineitem GROUP BY 1, 2),
lagged AS (
  SELECT *, lag(day) OVER w AS p_day, lag(debit) OVER w AS p_debit, lag(credit) OVER w AS p_credit
  FROM daily WINDOW w AS (PARTITION BY l_suppkey ORDER BY day))
"""


def sides(t: Tables) -> DataFrame:
    price, returned = cents("l_extendedprice"), F.col("l_returnflag") == "R"
    sums = {"debit": F.when(returned, price), "credit": F.when(~returned, price)}
    return c.daily_totals(t.lineitem, "l_suppkey", "l_shipdate", sums)


def _propagation_sql() -> str:
    made = []
    for col in ("debit", "credit"):
        for n in (1, 2, 3, 4):
            made.append(f"CAST(lag({col}, {n}) OVER w AS DOUBLE) AS {c.past_name(col, 'day', n)}")
        for unit, n in (("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1),
                        ("year", 2), ("week", 1), ("week", 2)):
            made.append(f"CAST({prev_sql(unit, n, col)} AS DOUBLE) AS {c.past_name(col, unit, n)}")
        quarter = OBSERVED.format(unit="quarter").replace("p_amount", f"p_{col}")
        made.append(f"CAST({quarter} AS DOUBLE) AS last_quarter_{col}")
        made.append(
            f"CAST(last_value(CASE WHEN day = CAST({R} - INTERVAL 12 MONTH AS DATE) THEN {col} END"
            f" IGNORE NULLS) OVER run AS DOUBLE) AS same_day_last_year_{col}"
        )
    return (
        SIDES + "SELECT l_suppkey, CAST(day AS VARCHAR) AS day, CAST(debit AS DOUBLE) AS debit,"
        " CAST(credit AS DOUBLE) AS credit,\n" + ",\n".join(made)
        + "\nFROM lagged WINDOW w AS (PARTITION BY l_suppkey ORDER BY day), run AS"
        " (PARTITION BY l_suppkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )


@query("win_balance_propagation", _propagation_sql())
def win_balance_propagation(t: Tables) -> DataFrame:
    return c.propagate_balances(
        sides(t), ["debit", "credit"], REF, "l_suppkey", "day",
        periods=[("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1),
                 ("year", 2), ("week", 1), ("week", 2)],
        observed=["quarter"],
    )


@query("win_propagation_as_of", f"SELECT * FROM ({_propagation_sql()}) AS t WHERE day = '{REF}'")
def win_propagation_as_of(t: Tables) -> DataFrame:
    """The rows of the reference date only, without a window over the history."""
    periods = [("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2), ("week", 1), ("week", 2)]
    return c.propagate_as_of(
        sides(t), ["debit", "credit"], REF, "l_suppkey", "day", periods=periods, observed=["quarter"]
    )


@query("win_propagation_incremental", ORACLES["win_propagation_as_of"])
def win_propagation_incremental(t: Tables) -> DataFrame:
    """The same from the state before the date, which is carried over four days: a state from
    the history, then a state and a day's rows at a time."""
    what = k.Carried.of(
        ["debit", "credit"], "l_suppkey", "day", observed=["quarter"],
        periods=[("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2), ("week", 1), ("week", 2)],
    )
    source, folder = sides(t), fresh_folder(t.spark, "carried")
    before = [p.shift_back(REF, "day", n) for n in (4, 3, 2, 1)]
    k.carry_forward(source, what, folder, before)
    return k.report(source, k.state_on(t.spark, folder, before[-1]), what, REF, same_day=source)


def _as_of(unit: str, n: int, col: str = "debit") -> str:
    months = {"month": 1, "quarter": 3, "year": 12}
    moved = f"CAST({R} - INTERVAL {7 * n} DAY AS DATE)" if unit == "week" else (
        f"CAST({R} - INTERVAL {months[unit] * n} MONTH AS DATE)"
    )
    inside = f"date_trunc('{unit}', day) = date_trunc('{unit}', {moved})"
    # arg_max would pass over null values of the period's last day
    return (
        f"CAST((max(CASE WHEN {inside} THEN struct_pack(d := day, v := {col}) END)).v AS DOUBLE)"
        f" AS {c.past_name(col, unit, n)}"
    )


_AS_OF = [("week", 1), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1), ("year", 2)]
_ANY = " OR ".join(
    f"date_trunc('{u}', day) = date_trunc('{u}', CAST({R} - INTERVAL {k} AS DATE))"
    for u, k in (("week", "7 DAY"), ("month", "1 MONTH"), ("month", "2 MONTH"),
                 ("quarter", "3 MONTH"), ("year", "12 MONTH"), ("year", "24 MONTH"))
)


@query(
    "win_values_as_of",
    SIDES + f"""SELECT l_suppkey, CAST(max(CASE WHEN day = {R} THEN debit END) AS DOUBLE) AS debit,
{", ".join(_as_of(u, n) for u, n in _AS_OF)}
FROM daily WHERE day = {R} OR {_ANY} GROUP BY l_suppkey""",
)
def win_values_as_of(t: Tables) -> DataFrame:
    return c.values_as_of(sides(t), "debit", REF, _AS_OF, "l_suppkey", "day")


def _variation_sql(col: str) -> list[str]:
    made = []
    for label, base in c.VARIATIONS:
        past = f"{base}_{col}"
        change = f"COALESCE({col} - {past}, {col}, {past}, 0)"
        made.append(f"CAST({change} AS DOUBLE) AS variation_{label}_{col}")
        made.append(
            f"CASE WHEN {past} <> 0 THEN CAST({change} AS DOUBLE) / CAST({past} AS DOUBLE) END"
            f" AS variation_{label}_pct_{col}"
        )
    return made


def _comparison_ctes() -> str:
    def layer(source: str, target: str, col: str) -> str:
        return f""", {target}_lag AS (
  SELECT *, lag(day) OVER w AS p_day, lag({col}) OVER w AS p_{col}, lag({col}, 5) OVER w AS last_5_days_{col}
  FROM {source} WINDOW w AS (PARTITION BY o_custkey ORDER BY day)), {target} AS (
  SELECT * EXCLUDE (p_day, p_{col}), {prev_sql('month', 1, col)} AS last_month_{col},
         {OBSERVED.format(unit='quarter').replace('p_amount', 'p_' + col)} AS last_quarter_{col},
         {prev_sql('year', 1, col)} AS last_year_{col}
  FROM {target}_lag WINDOW run AS (PARTITION BY o_custkey ORDER BY day
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""

    first = layer("daily", "compared", "amount")
    delta = """, with_delta AS (
  SELECT *, COALESCE(amount - last_year_amount, amount, last_year_amount, 0) AS delta_amount FROM compared)"""
    return DAILY + first + delta + layer("with_delta", "final", "delta_amount")


def _variations_query() -> str:
    plain = [f"CAST({base}_{col} AS DOUBLE) AS {base}_{col}"
             for col in ("amount", "delta_amount") for _, base in c.VARIATIONS]
    return (
        _comparison_ctes() + f"\nSELECT {IDS}, CAST(delta_amount AS DOUBLE) AS delta_amount,\n"
        + ",\n".join(plain + _variation_sql("amount") + _variation_sql("delta_amount"))
        + "\nFROM final"
    )


def variations(t: Tables, hot_rows: int | None = None) -> DataFrame:
    """Variations of daily totals; percentages are taken on doubles."""
    out = c.variation_kpis(daily(t), "amount", REF, KEYS, "day", hot_rows=hot_rows)
    return out.select(
        *[
            c.ratio(
                F.col(name.replace("_pct", "")).cast("double"),
                F.col(_base_of(name)).cast("double"),
            ).alias(name)
            if "_pct_" in name
            else F.col(name)
            for name in out.columns
        ]
    )


def _base_of(name: str) -> str:
    label, col = name.removeprefix("variation_").split("_pct_")
    return f"{dict(c.VARIATIONS)[label]}_{col}"


@query("win_variation_kpis", _variations_query())
def win_variation_kpis(t: Tables) -> DataFrame:
    return variations(t)


# --- states ------------------------------------------------------------------------------

STATES = """WITH daily AS (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, arg_max(o_orderstatus, o_orderkey) AS state
  FROM orders GROUP BY 1, 2),
lagged AS (
  SELECT *, lag(day) OVER w AS p_day, lag(state) OVER w AS p_state
  FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
"""


def states(t: Tables) -> DataFrame:
    """Each customer's last order status per day."""
    return t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max_by("o_orderstatus", "o_orderkey").alias("state")
    )


def observed_state_sql(unit: str) -> str:
    return OBSERVED.format(unit=unit).replace("p_amount", "p_state")


@query(
    "state_prev_observed",
    STATES + "SELECT o_custkey, CAST(day AS VARCHAR) AS day, state, "
    + ", ".join(f"{observed_state_sql(u)} AS prev_{u}_state" for u in ("week", "month", "quarter", "year"))
    + RUN,
)
def state_prev_observed(t: Tables) -> DataFrame:
    units = ["week", "month", "quarter", "year"]
    return c.prev_observed_state(states(t), "state", units, KEYS, "day")


@query(
    "state_prev_decoded",
    STATES + f""", seen AS (SELECT o_custkey, day, state, {observed_state_sql('month')} AS s{RUN})
SELECT o_custkey, CAST(day AS VARCHAR) AS day, state,
       CASE WHEN s IS NULL THEN NULL WHEN s IN ('O', 'P') THEN 'VALID' ELSE 'ENDED' END AS prev_month_state
FROM seen""",
)
def state_prev_decoded(t: Tables) -> DataFrame:
    return c.prev_observed_state(
        states(t), "state", ["month"], KEYS, "day", decode={"VALID": ["O", "P"]}, default="ENDED"
    )


# --- histories in segments: the same results with every longer history cut ---------------

CUT = 6  # rows, so that the histories of these tables are cut


@query("win_segmented_propagation", ORACLES["win_balance_propagation"])
def win_segmented_propagation(t: Tables) -> DataFrame:
    return c.propagate_balances(
        sides(t), ["debit", "credit"], REF, "l_suppkey", "day",
        periods=[("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1),
                 ("year", 2), ("week", 1), ("week", 2)],
        observed=["quarter"], hot_rows=CUT,
    )


@query("win_segmented_exact", ORACLES["win_prev_quarter_exact"])
def win_segmented_exact(t: Tables) -> DataFrame:
    return c.prev_observed_period_value(daily(t), "amount", "quarter", KEYS, "day", exact=True, hot_rows=CUT)


@query("win_segmented_variation", ORACLES["win_variation_kpis"])
def win_segmented_variation(t: Tables) -> DataFrame:
    return variations(t, hot_rows=CUT)


@query("state_prev_segmented", ORACLES["state_prev_observed"])
def state_prev_segmented(t: Tables) -> DataFrame:
    units = ["week", "month", "quarter", "year"]
    return c.prev_observed_state(states(t), "state", units, KEYS, "day", hot_rows=CUT)


# --- gaps -----------------------------------------------------------------------------------


@query(
    "fill_both_directions",
    """WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, MAX(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END) AS spent
  FROM events GROUP BY 1, 2),
spine AS (SELECT user_id, CAST(unnest(generate_series(MIN(day), MAX(day), INTERVAL 1 DAY)) AS DATE) AS day FROM daily GROUP BY 1)
SELECT spine.user_id, CAST(spine.day AS VARCHAR) AS day,
  CAST(COALESCE(
    first_value(spent IGNORE NULLS) OVER (PARTITION BY spine.user_id ORDER BY spine.day
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
    last_value(spent IGNORE NULLS) OVER (PARTITION BY spine.user_id ORDER BY spine.day
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS DOUBLE) AS spent
FROM spine LEFT JOIN daily ON daily.user_id = spine.user_id AND daily.day = spine.day""",
)
def fill_both_directions(t: Tables) -> DataFrame:
    """Each user's largest purchase per day from its first to its last event, with the gaps
    between purchases filled."""
    purchase = F.when(F.col("event_type") == "purchase", cents("value"))
    daily = t.events.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.max(purchase).alias("spent"))
    spine = daily.groupBy("user_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    spine = spine.select("user_id", F.explode(F.sequence("first", "last")).alias("day"))
    gaps = spine.join(daily, ["user_id", "day"], "left")
    return d.fill_nulls_bidirectional(gaps, ["spent"], "user_id", "day")


@query(
    "fill_expected_dates",
    f"""WITH days AS (SELECT CAST(g.d AS DATE) AS day
  FROM generate_series(DATE '2001-01-01', {R}, INTERVAL 1 DAY) AS g(d)),
seen AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
         WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '2001-01-01' AND {R})
SELECT CAST(days.day AS VARCHAR) AS expected_date,
       CAST(last_value(seen.day IGNORE NULLS) OVER (ORDER BY days.day
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS actual_date
FROM days LEFT JOIN seen ON seen.day = days.day""",
)
def fill_expected_dates(t: Tables) -> DataFrame:
    return d.expected_dates(t.orders, REF, "o_orderdate")
