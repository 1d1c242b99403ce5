"""Customer lifecycle: first orders as account openings, last shipments as closings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import REF, Tables, query
from querybook.comparisons import KEYS, RUN, STATES, observed_state_sql, states
from querybook.flags import months_between_sql
from tidemark.operators import comparison as c
from tidemark.operators import lifecycle as k
from tidemark.operators import scores as sc

UNITS = ("week", "month", "quarter", "year")

# Most customers place their first order in the first year of the data.
FIRST_REF = "1995-06-15"

# One account per order: opened on the order day; small orders stand for accounts
# opened by minors.
ACCOUNTS = f"""WITH accounts AS (
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS opened,
         DATE '{FIRST_REF}' AS snapshot
  FROM orders)
"""


def accounts(t: Tables) -> DataFrame:
    opened = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", opened.alias("opened"),
        F.lit(FIRST_REF).cast("date").alias("snapshot"),
    )


def _same(day: str, unit: str) -> str:
    return f"date_trunc('{unit}', {day}) = date_trunc('{unit}', snapshot)"


_FIRST = ACCOUNTS + """, firsts AS (
  SELECT *, MIN(CASE WHEN o_totalprice > 50000 THEN opened END) OVER (PARTITION BY o_custkey) AS first_opened
  FROM accounts)
"""


@query(
    "lifecycle_acquisition",
    _FIRST + "SELECT o_custkey, o_orderkey, CAST(first_opened AS VARCHAR) AS first_opened, "
    + ", ".join(f"CASE WHEN {_same('first_opened', u)} THEN 1 ELSE 0 END AS acquired_{u}" for u in UNITS)
    + " FROM firsts",
)
def lifecycle_acquisition(t: Tables) -> DataFrame:
    flagged = k.acquisition_flags(
        accounts(t), "o_custkey", "opened", "snapshot", adult=F.col("o_totalprice") > 50000
    )
    return flagged.drop("o_orderstatus", "o_totalprice", "opened", "snapshot")


@query(
    "lifecycle_active_acquisition",
    _FIRST + "SELECT o_custkey, o_orderkey, "
    + ", ".join(
        f"CASE WHEN {_same('first_opened', u)} AND o_orderstatus = 'O' AND o_totalprice > 200000"
        f" THEN 1 ELSE 0 END AS acquired_active_{u}" for u in UNITS
    )
    + " FROM firsts",
)
def lifecycle_active_acquisition(t: Tables) -> DataFrame:
    acquired = k.acquisition_flags(
        accounts(t), "o_custkey", "opened", "snapshot", adult=F.col("o_totalprice") > 50000
    )
    flagged = k.active_acquisition_flags(
        acquired, F.col("o_orderstatus") == "O", F.col("o_totalprice") > 200000
    )
    return flagged.select("o_custkey", "o_orderkey", *[f"acquired_active_{u}" for u in UNITS])


_CHURN = f"""WITH accounts AS (
  SELECT o_custkey, o_orderkey, o_orderpriority = '1-URGENT' AS is_open, closed, DATE '{REF}' AS snapshot
  FROM orders JOIN (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS closed FROM lineitem GROUP BY 1) AS t
    ON l_orderkey = o_orderkey),
marked AS (
  SELECT *, MAX(closed) OVER w AS last_closed, MAX(CAST(is_open AS INT)) OVER w = 0 AS all_closed FROM accounts
  WINDOW w AS (PARTITION BY o_custkey))
"""


@query(
    "lifecycle_churn",
    _CHURN + "SELECT o_custkey, o_orderkey, CAST(closed AS VARCHAR) AS closed,"
    " CAST(last_closed AS VARCHAR) AS last_closed, CAST(all_closed AS INT) AS all_closed, "
    + ", ".join(
        f"MAX(CASE WHEN {_same('closed', u)} AND all_closed THEN 1 ELSE 0 END)"
        f" OVER (PARTITION BY o_custkey) AS churned_{u}" for u in UNITS
    )
    + " FROM marked",
)
def lifecycle_churn(t: Tables) -> DataFrame:
    closings = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("closed")
    )
    rows = t.orders.join(closings, "o_orderkey").select(
        "o_custkey", "o_orderkey", (F.col("o_orderpriority") == "1-URGENT").alias("is_open"), "closed",
        F.lit(REF).cast("date").alias("snapshot"),
    )
    flagged = k.churn_flags(rows, "o_custkey", F.col("is_open"), "closed", "snapshot")
    return flagged.drop("is_open", "snapshot")


_OBSERVED = STATES + ", seen AS (SELECT o_custkey, day, state, " + ", ".join(
    f"{observed_state_sql(u)} AS prev_{u}_state" for u in UNITS
) + RUN + ")\n"


def with_previous_states(t: Tables) -> DataFrame:
    return c.prev_observed_state(states(t), "state", list(UNITS), KEYS, "day")


def _transition_sql(kind: str, rule: str) -> str:
    columns = ", ".join(
        f"CASE WHEN {rule.format(prev=f'prev_{u}_state')} THEN 1 ELSE 0 END AS {kind}_{u}" for u in UNITS
    )
    return _OBSERVED + f"SELECT o_custkey, CAST(day AS VARCHAR) AS day, {columns} FROM seen"


@query(
    "state_reactivation",
    _transition_sql("reactivated", "state = 'O' AND ({prev} <> 'O' OR {prev} IS NULL)"),
)
def state_reactivation(t: Tables) -> DataFrame:
    flagged = k.transition_flags(with_previous_states(t), "reactivated", "state", "O")
    return flagged.select("o_custkey", "day", *[f"reactivated_{u}" for u in UNITS])


@query(
    "state_inactivation",
    _transition_sql("inactivated", "(state <> 'O' OR state IS NULL) AND {prev} = 'O'"),
)
def state_inactivation(t: Tables) -> DataFrame:
    flagged = k.transition_flags(with_previous_states(t), "inactivated", "state", "O")
    return flagged.select("o_custkey", "day", *[f"inactivated_{u}" for u in UNITS])


@query(
    "state_active_delta",
    _OBSERVED + """SELECT o_custkey, CAST(day AS VARCHAR) AS day,
  CASE WHEN state = 'O' AND prev_year_state = 'F' THEN 1
       WHEN year(day) >= 2000 AND state = 'F' AND prev_year_state = 'O' THEN -1
       WHEN state = 'O' AND prev_year_state IS NULL THEN 1 ELSE 0 END AS active_delta FROM seen""",
)
def state_active_delta(t: Tables) -> DataFrame:
    delta = k.active_delta(
        with_previous_states(t), "state", "prev_year_state", F.year("day") >= 2000, "O", "F"
    )
    return delta.select("o_custkey", "day", "active_delta")


# --- scores ------------------------------------------------------------------------------

# Per customer: the first order and whether an order above 200,000 was placed in
# the reference month and in the two months before.
SCORED = """WITH flows AS (
  SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS opened,
""" + ",\n".join(
    f"  MAX(CASE WHEN o_totalprice >= 200000 AND date_trunc('month', o_orderdate) ="
    f" date_trunc('month', DATE '{FIRST_REF}' - INTERVAL {n} MONTH) THEN 1 ELSE 0 END) AS flag_m_{n}"
    for n in range(3)
) + """
  FROM orders GROUP BY 1)
"""


def monthly_flags(t: Tables) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    month = F.trunc(day, "month")
    this_month = F.trunc(F.lit(FIRST_REF).cast("date"), "month")
    reached = F.col("o_totalprice") >= 200000
    return t.orders.groupBy("o_custkey").agg(
        F.min(day).alias("opened"),
        *[
            F.max((reached & (month == F.add_months(this_month, -n))).cast("int")).alias(f"flag_m_{n}")
            for n in range(3)
        ],
    )


_START = "CAST(date_trunc('month', opened) + INTERVAL 1 MONTH AS DATE)"
_TENURE = "CAST(trunc(" + months_between_sql(f"DATE '{FIRST_REF}'", _START) + ") AS INT)"
TENURE_SCORE = """CASE WHEN tenure_months >= 3 THEN CAST(flag_m_0 + flag_m_1 + flag_m_2 >= 2 AS INT)
       WHEN tenure_months = 2 THEN CAST(flag_m_0 + flag_m_1 >= 1 AS INT)
       WHEN tenure_months = 1 THEN flag_m_0 ELSE 0 END"""


@query(
    "score_tenure",
    SCORED + f""", t AS (SELECT *, {_TENURE} AS tenure_months FROM flows)
SELECT o_custkey, CAST(opened AS VARCHAR) AS opened, flag_m_0, flag_m_1, flag_m_2, tenure_months,
  {TENURE_SCORE} AS tenure_score FROM t""",
)
def score_tenure(t: Tables) -> DataFrame:
    return sc.tenure_score(monthly_flags(t), "opened", ["flag_m_0", "flag_m_1", "flag_m_2"], FIRST_REF)


PARTS = """SELECT o_custkey,
    MAX(CAST(o_orderpriority = '1-URGENT' AS INT)) AS has_urgent,
    MAX(CAST(o_orderpriority = '2-HIGH' AS INT)) AS has_high,
    MAX(CAST(o_orderstatus = 'P' AS INT)) AS has_pending,
    MAX(CAST(o_totalprice > 400000 AS INT)) AS has_large
  FROM orders GROUP BY 1"""


def score_parts(t: Tables) -> DataFrame:
    rules = {
        "has_urgent": F.col("o_orderpriority") == "1-URGENT",
        "has_high": F.col("o_orderpriority") == "2-HIGH",
        "has_pending": F.col("o_orderstatus") == "P",
        "has_large": F.col("o_totalprice") > 400000,
    }
    return t.orders.groupBy("o_custkey").agg(
        *[F.max(rule.cast("int")).alias(name) for name, rule in rules.items()]
    )


WEIGHTS = {"has_urgent": 0.5, "has_high": 0.5, "has_pending": 0.5, "has_large": 1.0}


@query(
    "score_capped",
    f"""WITH parts AS ({PARTS})
SELECT *, CAST(LEAST(1.5, has_urgent * 0.5 + has_high * 0.5 + has_pending * 0.5 + has_large) AS DOUBLE) AS score
FROM parts""",
)
def score_capped(t: Tables) -> DataFrame:
    return sc.capped_score(score_parts(t), WEIGHTS)


@query(
    "score_stepped",
    """SELECT o_custkey, COUNT(*) AS n_orders,
  CAST(CASE WHEN COUNT(*) >= 12 THEN 1 WHEN COUNT(*) >= 8 THEN 0.5 ELSE 0 END AS DOUBLE) AS order_score
FROM orders GROUP BY 1""",
)
def score_stepped(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return counts.select("*", sc.stepped_score("n_orders", "order_score", [(12, 1), (8, 0.5)]))


@query(
    "score_lookup",
    f"""WITH parts AS ({PARTS}),
scored AS (SELECT o_custkey, has_large, CAST(0.5 * (has_urgent + has_high) AS DECIMAL(9,1)) AS score FROM parts),
rules AS (SELECT CAST(o_orderstatus = 'F' AS INT) AS has_large,
    CAST(0.5 * CAST(substr(o_orderpriority, 1, 1) AS INT) - 0.5 AS DECIMAL(9,1)) AS score, COUNT(*) AS level
  FROM orders GROUP BY 1, 2)
SELECT o_custkey, scored.has_large, CAST(scored.score AS DOUBLE) AS score, level
FROM scored LEFT JOIN rules ON rules.has_large = scored.has_large AND rules.score = scored.score""",
)
def score_lookup(t: Tables) -> DataFrame:
    """Rules come as text with a decimal comma, as ``'0,5'``."""
    parts = score_parts(t).select(
        "o_custkey", "has_large", (F.lit(0.5) * (F.col("has_urgent") + F.col("has_high"))).alias("score")
    )
    step = F.lit(0.5) * F.substring("o_orderpriority", 1, 1).cast("int") - F.lit(0.5)
    rules = t.orders.groupBy(
        (F.col("o_orderstatus") == "F").cast("int").alias("has_large"),
        F.regexp_replace(step.cast("string"), r"\.", ",").alias("text"),
    ).agg(F.count("*").alias("level"))
    rules = rules.select("has_large", sc.decimal_comma("text").alias("score"), "level")
    return sc.score_lookup(parts, rules, ["has_large", "score"])
