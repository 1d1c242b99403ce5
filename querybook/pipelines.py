"""The example pipelines on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import LABELS, REF, WIRE_KIND, Tables, cents, literal_rows, query, values_sql
from querybook.comparisons import OBSERVED, STATES, observed_state_sql, prev_sql, states
from querybook.flags import HOLIDAYS, closed_by, flags_sql, in_period, months_between_sql, rolling
from querybook.flows import LINES, RATES, lines, rates
from querybook.lifecycle import TENURE_SCORE
from querybook.objectives import SEASON, season
from tidemark.operators import comparison as c
from tidemark.operators import money as m
from tidemark.operators import objectives as o
from tidemark.operators.comparison import past_name
from tidemark.operators.joins import dealt
from tidemark.operators.shaping import Dimension
from tidemark.plans import balances as b
from tidemark.plans import customers as cu
from tidemark.plans import products as pr
from tidemark.plans import scores as sc

R = f"DATE '{REF}'"
PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"

# --- customer status: accounts are orders, balances and movements are line items -------------

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'PRO'
      WHEN c_mktsegment = 'FURNITURE' THEN 'CORPORATE' ELSE 'RETAIL' END AS market, opened
  FROM customer LEFT JOIN (SELECT o_custkey, MAX(CAST(o_orderdate AS DATE)) AS opened FROM orders GROUP BY 1) AS t
    ON o_custkey = c_custkey)"""


def customers(t: Tables) -> DataFrame:
    """The last order's date stands for the opening date."""
    opened = t.orders.groupBy(F.col("o_custkey").alias("customer")).agg(
        F.max(F.col("o_orderdate").cast("date")).alias("opened")
    )
    market = (
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "PRO")
        .when(F.col("c_mktsegment") == "FURNITURE", "CORPORATE")
        .otherwise("RETAIL")
    )
    base = t.customer.select(F.col("c_custkey").alias("customer"), market.alias("market"))
    return base.join(opened, "customer", "left")


def accounts(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("customer"))


@query(
    "plan_customer_status",
    f"""WITH {CUSTOMERS}, {RATES}, {LINES},
flow AS (
  SELECT l_orderkey AS account, SUM(COALESCE(CAST(amount * CASE WHEN lines.currency = '1-URGENT' THEN 1 ELSE mid END AS DECIMAL(30,4)), 0)) AS flow
  FROM lines LEFT JOIN rates ON rates.currency = lines.currency AND rates.quote_date = lines.day WHERE side = 'C' GROUP BY 1),
recent AS (SELECT DISTINCT l_orderkey AS account FROM lines
  WHERE kind = 'VIREMENT' AND l_linenumber IN (1, 2) AND {months_between_sql(R, 'day')} BETWEEN 0 AND 6),
held AS (
  SELECT l_orderkey AS account, MAX(CASE WHEN l_returnflag <> 'R' THEN {PRICE} END) AS credit,
    MAX(CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' AND {PRICE} >= 20000 THEN 1 ELSE 0 END) AS engaged,
    MAX(CASE WHEN l_linenumber = 6 AND l_returnflag <> 'R' AND {PRICE} >= 20000 THEN 1 ELSE 0 END) AS saver
  FROM lineitem GROUP BY 1),
per_customer AS (
  SELECT o_custkey AS customer, SUM(flow) AS flow, MAX(credit) AS credit, MAX(CASE WHEN recent.account IS NOT NULL THEN 1 ELSE 0 END) AS moved,
    MAX(engaged) AS engaged, MAX(saver) AS saver
  FROM orders LEFT JOIN flow ON flow.account = o_orderkey LEFT JOIN recent ON recent.account = o_orderkey
  LEFT JOIN held ON held.account = o_orderkey GROUP BY 1),
judged AS (
  SELECT customer, flow, opened, COALESCE({months_between_sql(R, 'opened')} <= 36 AND {months_between_sql(R, 'opened')} > 0
      AND flow / 100 < 2000000, FALSE) AS entering,
    COALESCE(credit >= CASE market WHEN 'PRO' THEN 102000 ELSE 98000 END, FALSE) OR COALESCE(moved + engaged + saver > 0, FALSE) AS any_rule
  FROM customers LEFT JOIN per_customer USING (customer) WHERE market <> 'CORPORATE')
SELECT customer, CAST(flow AS DOUBLE) / 100 AS credit_flow, CAST(any_rule AND NOT entering AS INT) AS is_active,
  CAST(NOT any_rule AND NOT entering AS INT) AS is_inactive, CAST(entering AS INT) AS is_entering,
  CAST(any_rule AND NOT entering AND COALESCE(year(opened) = 2001, FALSE) AS INT) AS is_acquired_active
FROM judged""",
)
def plan_customer_status(t: Tables) -> DataFrame:
    moved = lines(t).select(
        F.col("l_orderkey").alias("account"), "day", "currency",
        "amount", "side",
        F.concat_ws("-", F.col("kind"), F.col("l_linenumber").cast("string")).alias("operation"),
    )
    operations = literal_rows(t.spark, "operation string", [("VIREMENT-1",), ("VIREMENT-2",)])
    returned = F.col("l_returnflag") == "R"
    amount = cents("l_extendedprice")
    held = t.lineitem.select(
        F.col("l_orderkey").alias("account"), F.when(returned, amount).alias("debit"),
        F.when(~returned, amount).alias("credit"), F.col("l_linenumber").cast("string").alias("kind"),
    )
    status = cu.customer_status(
        customers(t), accounts(t), held, moved, rates(t), operations, REF,
        loan_kinds=["7"], resource_kinds=["6"], home="1-URGENT",
        limits={"RETAIL": 98000, "PRO": 102000}, engaged_from=20000, entry_flow=2000000,
    )
    hundredths = (F.col("credit_flow") * 100).cast("decimal(30,4)").cast("double")
    return status.withColumn("credit_flow", hundredths / 100)


# --- customer KPIs ------------------------------------------------------------------------

BOUNDS = {
    "s": ("week", 0), "s_1": ("week", 1), "m": ("month", 0), "m_1": ("month", 1), "m_2": ("month", 2),
    "t": ("quarter", 0), "t_1": ("quarter", 1), "y": ("year", 0), "y_1": ("year", 1),
}
STARTS = {
    "s": f"date_trunc('week', {R})", "s_1": f"date_trunc('week', {R} - INTERVAL 7 DAY)",
    "m": f"date_trunc('month', {R})", "m_1": f"date_trunc('month', {R} - INTERVAL 1 MONTH)",
    "m_2": f"date_trunc('month', {R} - INTERVAL 2 MONTH)", "t": f"date_trunc('quarter', {R})",
    "t_1": f"date_trunc('quarter', {R} - INTERVAL 3 MONTH)", "y": "DATE '2001-01-01'", "y_1": "DATE '2000-10-01'",
}


def _new(suffix: str) -> str:
    rule = in_period("opened", REF)(*BOUNDS[suffix])
    if suffix == "y_1":
        rule += " AND quarter(opened) = 4"
    return f"COALESCE({rule}, FALSE)"


def _kpi_columns() -> str:
    made = []
    for suffix in BOUNDS:
        flow, new = f"COALESCE(sum_{suffix}, 0)", _new(suffix)
        made.append(f"CAST({new} AS INT) AS acquired_{suffix}")
        made.append(f"CAST({new} AND {flow} >= 200000 AS INT) AS acquired_active_{suffix}")
        made.append(f"CAST({new} AND {flow} < 200000 AS INT) AS acquired_ongoing_{suffix}")
    return ", ".join(made)


def _history(unit: str) -> str:
    moved = {"week": "7 DAY", "month": "1 MONTH", "quarter": "3 MONTH", "year": "12 MONTH"}[unit]
    inside = f"date_trunc('{unit}', day) = date_trunc('{unit}', {R} - INTERVAL {moved})"
    return (
        f"CAST((MAX(CASE WHEN {inside} THEN struct_pack(d := day, v := is_active) END)).v AS INT)"
        f" AS {past_name('is_active', unit)}"
    )


@query(
    "plan_customer_kpis",
    STATES + f""", {CUSTOMERS}, sums AS (
  SELECT o_custkey AS customer, """ + ", ".join(
        f"SUM(CASE WHEN l_shipdate >= {start} THEN {PRICE} END) AS sum_{n}" for n, start in STARTS.items()
    ) + f""" FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag <> 'R' GROUP BY 1),
status AS (SELECT o_custkey AS customer, day, CAST(state = 'O' AS INT) AS is_active FROM daily),
history AS (SELECT customer, CAST(MAX(CASE WHEN day = {R} THEN is_active END) AS INT) AS is_active,
  {", ".join(_history(u) for u in ("week", "month", "quarter", "year"))} FROM status GROUP BY 1)
SELECT customers.customer, {_kpi_columns()}, CAST(COALESCE(sum_y, 0) AS DOUBLE) AS flow_year,
  is_active, last_week_is_active, last_month_is_active, last_quarter_is_active, last_year_is_active
FROM customers LEFT JOIN sums USING (customer) LEFT JOIN history USING (customer)""",
)
def plan_customer_kpis(t: Tables) -> DataFrame:
    credits = t.lineitem.where("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("account"), F.col("l_shipdate").cast("date").alias("day"),
        cents("l_extendedprice").alias("amount"),
    )
    history = states(t).select(
        F.col("o_custkey").alias("customer"), "day", (F.col("state") == "O").cast("int").alias("is_active")
    )
    return cu.customer_kpis(
        customers(t).select("customer", "opened"), accounts(t), credits, history, REF, threshold=200000
    )


# --- portfolio report ------------------------------------------------------------------------

_UNITS = ("week", "month", "quarter", "year")


def _same(day: str, unit: str) -> str:
    return f"date_trunc('{unit}', {day}) = date_trunc('{unit}', DATE '2001-03-20')"


@query(
    "plan_portfolio_report",
    STATES.replace("FROM orders GROUP", "FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2001-03-20' GROUP")
    + ", seen AS (SELECT o_custkey, day, state, "
    + ", ".join(f"{observed_state_sql(u)} AS prev_{u}_state" for u in _UNITS)
    + """ FROM lagged WINDOW run AS (PARTITION BY o_custkey ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
closings AS (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS closed FROM lineitem GROUP BY 1),
owned AS (
  SELECT o_custkey, MIN(CASE WHEN o_totalprice > 50000 THEN CAST(o_orderdate AS DATE) END) AS opened, MAX(closed) AS last_closed,
    MAX(CAST(o_orderpriority = '1-URGENT' AS INT)) = 0 AS all_closed, MAX(CAST(o_totalprice > 300000 AS INT)) = 1 AS owns, """
    + ", ".join(f"COALESCE(MAX(CAST({_same('closed', u)} AS INT)), 0) = 1 AS in_{u}" for u in _UNITS)
    + """ FROM orders LEFT JOIN closings ON l_orderkey = o_orderkey GROUP BY 1)
SELECT seen.o_custkey AS customer, CAST(day AS VARCHAR) AS day, state, """
    + ", ".join(f"prev_{u}_state" for u in _UNITS) + ", "
    + ", ".join(f"CASE WHEN state = 'O' AND (prev_{u}_state <> 'O' OR prev_{u}_state IS NULL) THEN 1 ELSE 0 END AS reactivated_{u}" for u in _UNITS) + ", "
    + ", ".join(f"CASE WHEN state <> 'O' AND prev_{u}_state = 'O' THEN 1 ELSE 0 END AS inactivated_{u}" for u in _UNITS)
    + ", CAST(opened AS VARCHAR) AS first_opened, CAST(last_closed AS VARCHAR) AS last_closed, "
    + ", ".join(f"CASE WHEN {_same('opened', u)} THEN 1 ELSE 0 END AS acquired_{u}" for u in _UNITS) + ", "
    + ", ".join(f"CASE WHEN {_same('opened', u)} AND owns AND state = 'O' THEN 1 ELSE 0 END AS acquired_active_{u}" for u in _UNITS) + ", "
    + ", ".join(f"CASE WHEN in_{u} AND all_closed THEN 1 ELSE 0 END AS churned_{u}" for u in _UNITS)
    + " FROM seen LEFT JOIN owned ON owned.o_custkey = seen.o_custkey WHERE day = DATE '2001-03-20'",
)
def plan_portfolio_report(t: Tables) -> DataFrame:
    history = states(t).withColumnRenamed("o_custkey", "customer")
    closings = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.col("l_shipdate").cast("date")).alias("closed")
    )
    held = t.orders.join(closings, "o_orderkey", "left").select(
        F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("date").alias("opened"), "closed",
        (F.col("o_orderpriority") == "1-URGENT").alias("is_open"), (F.col("o_totalprice") > 50000).alias("adult"),
        "o_totalprice",
    )
    return cu.portfolio_report(history, held, "2001-03-20", "O", owns=F.col("o_totalprice") > 300000)


# --- products ----------------------------------------------------------------------------------

_DAY = "CAST(o_orderdate AS DATE)"


def _rolled(name: str, predicate, source: str, key: str) -> str:
    return f"(SELECT {key}, " + flags_sql(name, predicate, "MAX(CAST({} AS INT))") + f" FROM {source} GROUP BY 1)"


def _filled(alias: str, name: str) -> str:
    return ", ".join(f"COALESCE({alias}.{flag}, 0) AS {flag}" for flag in pr.p.flag_names(name))


def _product_flags_sql(rule) -> str:
    return f"""WITH ships AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_linestatus = 'O'),
valid AS {_rolled('valid', rule('day', REF), 'ships', 'l_orderkey')},
finished AS (SELECT o_custkey, {_DAY} AS day FROM orders WHERE o_orderstatus = 'F'),
withdrawn AS {_rolled('withdrawn', rule('day', REF), 'finished', 'o_custkey')},
pending AS (SELECT o_custkey, {_DAY} AS day FROM orders WHERE o_orderstatus = 'P'),
active AS {_rolled('active', rolling('day', REF), 'pending', 'o_custkey')},
firsts AS (SELECT o_custkey, MIN(day) AS day FROM pending GROUP BY 1),
activated AS (SELECT o_custkey, {flags_sql('activated', closed_by('day', REF))} FROM firsts)
SELECT o_orderkey AS contract, orders.o_custkey AS card, {flags_sql('subscribed', in_period(_DAY, REF))},
  {_filled('valid', 'valid')}, {_filled('withdrawn', 'withdrawn')}, {_filled('active', 'active')}, {_filled('activated', 'activated')}
FROM orders LEFT JOIN valid ON l_orderkey = o_orderkey LEFT JOIN withdrawn ON withdrawn.o_custkey = orders.o_custkey
LEFT JOIN active ON active.o_custkey = orders.o_custkey LEFT JOIN activated ON activated.o_custkey = orders.o_custkey"""


def _product_flags(t: Tables, within_period: bool) -> DataFrame:
    def orders_of(status: str, name: str) -> DataFrame:
        return t.orders.where(F.col("o_orderstatus") == status).select(
            F.col("o_custkey").alias("card"), F.col("o_orderdate").alias(name)
        )

    contracts = t.orders.select(
        F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("card"),
        F.col("o_orderdate").alias("subscribed_on"),
    )
    history = t.lineitem.select(
        F.col("l_orderkey").alias("contract"), F.col("l_linestatus").alias("state"),
        F.col("l_shipdate").alias("snapshot"),
    )
    flagged = pr.product_flags(
        contracts, history, orders_of("F", "withdrawn_on"), orders_of("P", "used_at"), REF, ["O"],
        within_period=within_period,
    )
    return flagged.drop("subscribed_on")


@query("plan_product_flags", _product_flags_sql(closed_by))
def plan_product_flags(t: Tables) -> DataFrame:
    return _product_flags(t, within_period=False)


@query("plan_product_flags_within", _product_flags_sql(in_period))
def plan_product_flags_within(t: Tables) -> DataFrame:
    """Valid and withdrawn looked at in the period only."""
    return _product_flags(t, within_period=True)


@query(
    "plan_card_transactions",
    """WITH routed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS card, CAST(l_shipdate AS DATE) AS used_at,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'withdrawal' WHEN l_returnflag = 'R' THEN 'foreign withdrawal'
         WHEN l_discount > 0.02 THEN 'purchase' END AS route, p_brand AS merchant
  FROM lineitem JOIN part ON p_partkey = l_partkey),
kept AS (SELECT * FROM routed WHERE route IS NOT NULL)
SELECT l_orderkey, l_linenumber, l_partkey, card, CAST(used_at AS VARCHAR) AS used_at, route, merchant,
  CASE WHEN s_acctbal > 0 THEN s_acctbal END AS issued_on,
  CAST(CASE WHEN s_acctbal > 0 THEN MIN(used_at) OVER (PARTITION BY card) END AS VARCHAR) AS first_used
FROM kept LEFT JOIN supplier ON s_suppkey = card""",
)
def plan_card_transactions(t: Tables) -> DataFrame:
    uses = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("card"),
        F.col("l_shipdate").cast("date").alias("used_at"), "l_returnflag", "l_linestatus", "l_discount",
    )
    returned = F.col("l_returnflag") == "R"
    routes = {
        "withdrawal": returned & (F.col("l_linestatus") == "O"),
        "foreign withdrawal": returned,
        "purchase": F.col("l_discount") > 0.02,
    }
    merchants = Dimension(t.part, {"l_partkey": "p_partkey"}, {"merchant": "p_brand"}, "inner")
    cards = t.supplier.select(
        F.col("s_suppkey").alias("card"),
        F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("issued_on"),
    )
    out = pr.card_transactions(uses, routes, [merchants], cards)
    return out.drop("l_returnflag", "l_linestatus", "l_discount")


CODES = [
    ("state", "F", "finished", "2099-12-31"), ("state", "O", "open", "2099-12-31"),
    ("state", "O", "opened long ago", "1990-01-01"), ("state", "P", "pending", "2099-12-31"),
    ("other", "P", "wrong keyword", "2099-12-31"),
]
TYPES = [
    ("1-URGENT", "urgent", "2099-12-31"), ("2-HIGH", "high", "2099-12-31"), ("3-MEDIUM", "medium", "2099-12-31"),
    ("4-NOT SPECIFIED", "none", "1999-01-01"), ("5-LOW", "low", "2099-12-31"),
]
BILLING = [("1-URGENT", "X", "2099-12-31"), ("2-HIGH", "NP", "2099-12-31"), ("3-MEDIUM", "M", "2099-12-31")]


@query(
    "plan_direct_debits",
    f"""WITH codes(keyword, code, decoded, dfval) AS ({values_sql(CODES)}), types(kind, label, dfval) AS ({values_sql(TYPES)}),
bills(kind, billing, dfval) AS ({values_sql(BILLING)}),
joined AS (
  SELECT l_orderkey AS contract, o_custkey AS external, l_linenumber, l_partkey, o_orderpriority AS kind, types.label, o_orderstatus AS state,
    codes.decoded AS state_label,
    CASE WHEN o_orderstatus = 'O' OR (o_orderstatus = 'P' AND CAST(o_orderdate AS DATE) > {R}) THEN 'VALID' ELSE 'NOT VALID' END AS validity,
    l_returnflag AS operation,
    CASE WHEN o_orderpriority = '1-URGENT' AND l_returnflag = 'R' THEN 'A' WHEN o_orderpriority = '1-URGENT' AND l_returnflag = 'N' THEN 'M'
         ELSE bills.billing END AS billing,
    CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'non-bank' ELSE 'bank' END AS category, CAST({PRICE} AS DOUBLE) / 100 AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN types ON types.kind = o_orderpriority AND CAST(types.dfval AS DATE) > {R}
  JOIN codes ON codes.code = o_orderstatus AND keyword = 'state' AND CAST(codes.dfval AS DATE) > {R}
  LEFT JOIN bills ON bills.kind = o_orderpriority)
SELECT * FROM joined WHERE billing <> 'NP'""",
)
def plan_direct_debits(t: Tables) -> DataFrame:
    contracts = t.orders.select(
        F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("external"),
        F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("state"),
        F.col("o_orderdate").alias("due_on"),
    )
    owners = t.orders.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("external"))
    movements = t.lineitem.select(
        F.col("l_orderkey").alias("contract"), "l_linenumber", "l_partkey",
        F.col("l_returnflag").alias("operation"), cents("l_extendedprice").cast("double").alias("amount"),
    ).join(owners, "contract")
    dated = "kind string, {} string, dfval string"
    debits = pr.direct_debits(
        contracts, movements,
        literal_rows(t.spark, dated.format("label"), TYPES),
        literal_rows(t.spark, "keyword string, code string, decoded string, dfval string", CODES),
        literal_rows(t.spark, dated.format("billing"), BILLING),
        literal_rows(t.spark, "kind string", [("3-MEDIUM",)]),
        REF, valid_states=["O"], valid_until_due=["P"],
        billing_rules={("1-URGENT", "R"): "A", ("1-URGENT", "N"): "M"},
    )
    return debits.drop("due_on")


# --- balances --------------------------------------------------------------------------------

# One balance per supplier, order currency and day; the class is the part's brand
# digit of the smallest part, mapped to an account side.
_BALANCES = f"""balances AS (
  SELECT l_suppkey AS account, o_orderpriority AS currency, CAST(l_shipdate AS DATE) AS day,
    CASE WHEN MIN(l_linestatus) = 'O' THEN 'VIREMENT' ELSE 'BILLET' END AS kind, MIN(l_partkey) % 4 AS class,
    SUM(CASE WHEN l_returnflag = 'R' THEN {PRICE} END) AS debit, SUM(CASE WHEN l_returnflag <> 'R' THEN {PRICE} END) AS credit
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)"""
SIDES = [(0, "AA"), (1, "AP"), (2, "PP")]
_FACT_PERIODS = [("month", 1), ("month", 2), ("month", 3), ("month", 4), ("year", 1), ("year", 2)]


def _rate(amount: str) -> str:
    note = "CAST((low + high) * 0.5 AS DECIMAL(12,4))"
    return (
        f"CASE WHEN b.currency = '1-URGENT' THEN CAST({amount} AS DECIMAL(38,4)) WHEN kind = 'VIREMENT'"
        f" THEN CAST({amount} * mid AS DECIMAL(38,4)) ELSE CAST({amount} * {note} AS DECIMAL(38,4)) END AS {amount}_home"
    )


def _fact_sql() -> str:
    past = {}
    for side in ("debit_home", "credit_home"):
        for n in (1, 2, 3, 4):
            nth = f"(SELECT day FROM (SELECT DISTINCT day FROM balances WHERE day < {R}) ORDER BY day DESC LIMIT 1 OFFSET {n - 1})"
            past[past_name(side, "day", n)] = f"max(CASE WHEN day = {nth} THEN {side} END)"
        for unit, n in _FACT_PERIODS:
            months = n * {"month": 1, "year": 12}[unit]
            inside = f"date_trunc('{unit}', day) = date_trunc('{unit}', CAST({R} - INTERVAL {months} MONTH AS DATE))"
            close = f"(SELECT max(day) FROM balances WHERE {inside})"
            past[past_name(side, unit, n)] = f"max(CASE WHEN day = {close} THEN {side} END)"
        past[f"same_day_last_year_{side}"] = f"max(CASE WHEN day = DATE '2000-06-15' THEN {side} END)"
    compared = ", ".join(f"{sql} AS {name}" for name, sql in past.items())
    debits = ["debit", "debit_home"] + [n for n in past if n.endswith("debit_home")]
    netted = []
    for d in debits:
        cr = d.replace("debit", "credit")
        netted.append(
            f"CASE WHEN side = 'AA' THEN COALESCE({d}, 0) - COALESCE({cr}, 0) WHEN side = 'AP' AND {d} >= 0 THEN {d} END AS {d}"
        )
        netted.append(
            f"CASE WHEN side = 'PP' THEN COALESCE({cr}, 0) - COALESCE({d}, 0) WHEN side = 'AP' AND {cr} >= 0 THEN {cr} END AS {cr}"
        )
    credits = [d.replace("debit", "credit") for d in debits]
    kept = [f"CAST(CASE WHEN side = 'AP' AND split.category = 'RESSOURCE' THEN NULL ELSE {d} END AS DOUBLE) AS {d}" for d in debits]
    kept += [f"CAST(CASE WHEN side = 'AP' AND split.category = 'EMPLOI' THEN NULL ELSE {cr} END AS DOUBLE) AS {cr}" for cr in credits]
    return f"""WITH {RATES}, {_BALANCES}, sides(class, side) AS ({values_sql(SIDES)}),
converted AS (
  SELECT b.*, {_rate('debit')}, {_rate('credit')} FROM balances AS b
  LEFT JOIN rates ON rates.currency = b.currency AND rates.quote_date = b.day),
compared AS (SELECT account, currency, {", ".join(f"max(CASE WHEN day = {R} THEN {c} END) AS {c}" for c in ("day", "kind", "class", "debit", "credit", "debit_home", "credit_home"))},
  {compared} FROM converted GROUP BY account, currency HAVING bool_or(day = {R})),
netted AS (SELECT account, currency, kind, CAST(compared.class AS BIGINT) AS class, side, day, {", ".join(netted)}
  FROM compared LEFT JOIN sides ON sides.class = compared.class WHERE day = {R}),
split AS (
  SELECT *, CASE side WHEN 'AA' THEN 'EMPLOI' WHEN 'PP' THEN 'RESSOURCE' END AS category FROM netted WHERE side IS DISTINCT FROM 'AP'
  UNION ALL SELECT *, 'RESSOURCE' FROM netted WHERE side = 'AP' UNION ALL SELECT *, 'EMPLOI' FROM netted WHERE side = 'AP')
SELECT account, currency, kind, class, side, CAST(day AS VARCHAR) AS day, category, {", ".join(kept)} FROM split"""


@query("plan_balance_fact", _fact_sql())
def plan_balance_fact(t: Tables) -> DataFrame:
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("currency"))
    price, returned = cents("l_extendedprice"), F.col("l_returnflag") == "R"
    held = t.lineitem.join(owners, "l_orderkey").groupBy(
        F.col("l_suppkey").alias("account"), "currency", F.col("l_shipdate").cast("date").alias("day")
    ).agg(
        F.when(F.max(F.col("l_linestatus") == "F"), "BILLET").otherwise("VIREMENT").alias("kind"),
        (F.min("l_partkey") % 4).alias("class"),
        F.sum(F.when(returned, price)).alias("debit"),
        F.sum(F.when(~returned, price)).alias("credit"),
    )
    mapping = literal_rows(t.spark, "class bigint, side string", SIDES)
    return b.balance_fact(held, rates(t), mapping, REF, home="1-URGENT", wire_kind=WIRE_KIND, labels=LABELS)


_DAILY = """daily AS (
  SELECT s_nationkey AS unit, p_type AS product, CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
  WHERE CAST(l_shipdate AS DATE) <= DATE '2001-06-15' GROUP BY 1, 2, 3)"""


def _change(base: str) -> str:
    return f"COALESCE(CAST(amount AS DOUBLE) - CAST({base} AS DOUBLE), CAST(amount AS DOUBLE), CAST({base} AS DOUBLE), 0)"


def _commercial_sql() -> str:
    pasts = {"week": "last_5_days_amount", "month": "last_month_amount", "quarter": "last_quarter_amount", "year": "last_year_amount"}
    variations = ", ".join(
        f"{_change(past)} AS variation_{u}_amount,"
        f" CASE WHEN {past} <> 0 THEN {_change(past)} / CAST({past} AS DOUBLE) END AS variation_{u}_pct_amount"
        for u, past in pasts.items()
    )
    plain = ", ".join(f"CAST({past} AS DOUBLE) AS {past}" for past in pasts.values())
    run = "PARTITION BY unit, product ORDER BY day"
    oq, op, v, q = "pct_quarter * annual", "pct_cum * annual", "variation_year_amount", "variation_quarter_amount"
    return f"""WITH {_DAILY}, {SEASON},
marked AS (SELECT *, CASE WHEN week <= 13 THEN 1 WHEN week <= 26 THEN 2 WHEN week <= 39 THEN 3 ELSE 4 END AS q FROM season),
weeks AS (SELECT year, week, CAST(pct_week AS DOUBLE) AS pct_week, CAST(pct_cum AS DOUBLE) AS pct_cum,
  CAST(first_value(pct_cum) OVER (PARTITION BY year, q ORDER BY week DESC) AS DOUBLE) AS pct_quarter FROM marked),
targets AS (SELECT s_nationkey AS unit, p_type AS product, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS annual
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey WHERE year(l_shipdate) = 2000 GROUP BY 1, 2),
lagged AS (SELECT *, lag(day) OVER w AS p_day, lag(amount) OVER w AS p_amount FROM daily WINDOW w AS ({run})),
compared AS (SELECT unit, product, day, amount, lag(amount, 5) OVER w AS last_5_days_amount, {prev_sql('month', 1)} AS last_month_amount,
  {OBSERVED.format(unit='quarter')} AS last_quarter_amount, {prev_sql('year', 1)} AS last_year_amount
  FROM lagged WINDOW w AS ({run}), run AS ({run} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
kpi AS (SELECT unit, product, day, CAST(amount AS DOUBLE) AS amount, {plain}, {variations}, CAST(year(day) AS INT) AS year,
  CAST(weekofyear(day) AS INT) AS week FROM compared WHERE day = {R})
SELECT kpi.* REPLACE (CAST(day AS VARCHAR) AS day), annual, pct_week * annual AS objective_week, {oq} AS objective_quarter, {op} AS objective_period,
  CASE WHEN {op} <> 0 THEN {v} / ({op}) END AS attainment_period, CASE WHEN {oq} <> 0 THEN {q} / ({oq}) END AS attainment_quarter,
  COALESCE({oq} - {q}, {oq}, {q}, 0) AS remaining_quarter, COALESCE(annual - {v}, annual, {v}, 0) AS remaining_year
FROM kpi LEFT JOIN weeks USING (year, week) LEFT JOIN targets USING (unit, product)"""


@query("plan_commercial_report", _commercial_sql())
def plan_commercial_report(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("unit"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    sold = t.lineitem.join(suppliers, "l_suppkey").join(parts, "l_partkey")
    daily = c.daily_totals(sold, ["unit", "product"], "l_shipdate", {"amount": cents("l_extendedprice")})
    targets = sold.where("year(l_shipdate) = 2000").groupBy("unit", "product").agg(
        F.sum(cents("l_extendedprice")).cast("double").alias("annual")
    )
    marked = season(t).withColumn("quarter", o.band(F.col("week"), o.QUARTER_LAST_WEEK))
    pct = ["pct_week", "pct_cum", "pct_quarter"]
    weeks = o.quarter_percent(marked).select("year", "week", *[F.col(p).cast("double").alias(p) for p in pct])
    as_double = daily.withColumn("amount", F.col("amount").cast("double"))
    return b.commercial_report(as_double, targets, weeks, REF, "unit")


_POSITIONS = """held AS (
  SELECT l_suppkey AS account, l_partkey AS security, CAST(date_trunc('month', l_shipdate) AS DATE) AS day,
    SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantity FROM lineitem GROUP BY 1, 2, 3),
quotes AS (
  SELECT l_partkey AS security, CAST(date_trunc('month', l_shipdate) AS DATE) AS day, CAST(l_shipdate AS DATE) AS quote_date,
    MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS price FROM lineitem GROUP BY 1, 2, 3),
latest AS (SELECT security, day, arg_max(price, quote_date) AS price FROM quotes GROUP BY 1, 2),
valued AS (SELECT account, security, day, round(quantity * price, 2) AS value FROM held JOIN latest USING (security, day)
  WHERE quantity > 0 AND price > 0)"""
_PERIODS = [("week", 1), ("week", 2), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1)]


def _position(unit: str, n: int) -> str:
    span = f"{7 * n} DAY" if unit == "week" else f"{ {'month': 1, 'quarter': 3, 'year': 12}[unit] * n} MONTH"
    inside = f"date_trunc('{unit}', day) = date_trunc('{unit}', DATE '2001-06-01' - INTERVAL {span})"
    return (
        f"COALESCE(CAST(arg_max(CASE WHEN {inside} THEN value END, CASE WHEN {inside} THEN day END) AS DOUBLE), 0)"
        f" AS {past_name('value', unit, n)}"
    )


@query(
    "plan_position_report",
    f"""WITH {_POSITIONS}, now AS (
  SELECT account, security, CAST(MAX(CASE WHEN day = DATE '2001-06-01' THEN value END) AS DOUBLE) AS value,
    {", ".join(_position(u, n) for u, n in _PERIODS)} FROM valued GROUP BY 1, 2)
SELECT * FROM now WHERE value IS NOT NULL""",
)
def plan_position_report(t: Tables) -> DataFrame:
    """Monthly holdings per supplier and part, at the month's last price."""
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").alias("day")
    positions = t.lineitem.select(
        F.col("l_suppkey").alias("account"), F.col("l_partkey").alias("security"), month,
        cents("l_quantity").alias("quantity"),
    )
    quotes = t.lineitem.select(
        F.col("l_partkey").alias("isin"), month, F.col("l_shipdate").cast("date").alias("quote_date"),
        cents("l_extendedprice").alias("price"),
    )
    securities = t.part.select(F.col("p_partkey").alias("security"), F.col("p_partkey").alias("isin"))
    return b.position_report(positions, securities, quotes, "2001-06-01")


@query(
    "plan_loan_production",
    f"""WITH holidays(holiday) AS ({values_sql(HOLIDAYS)}),
paid AS (
  SELECT o_orderkey AS loan, o_custkey AS account, o_orderstatus AS family, o_orderpriority AS source, CAST(o_orderdate AS DATE) AS paid_on,
    CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders),
days AS (SELECT DISTINCT paid_on FROM paid),
found AS (SELECT paid_on, MAX(d) AS business_day
  FROM (SELECT paid_on, CAST(paid_on - CAST(i AS INT) AS DATE) AS d FROM days, generate_series(1, 8) AS g(i)) AS x
  WHERE dayofweek(d) NOT IN (0, 6) AND CAST(d AS VARCHAR) NOT IN (SELECT holiday FROM holidays) GROUP BY 1),
owed AS (SELECT account, family, paid_on AS business_day, SUM(amount) AS owed FROM paid GROUP BY 1, 2, 3)
SELECT loan, account, family, source, CAST(paid_on AS VARCHAR) AS paid_on, CAST(amount AS DOUBLE) AS amount,
  CAST(business_day AS VARCHAR) AS business_day, CAST(owed AS DOUBLE) AS owed, CAST(amount - COALESCE(owed, 0) AS DOUBLE) AS net_amount,
  {flags_sql('production', in_period('paid_on', REF))}, concat_ws('', loan, source) AS loan_key
FROM paid LEFT JOIN found USING (paid_on) LEFT JOIN owed USING (account, family, business_day)""",
)
def plan_loan_production(t: Tables) -> DataFrame:
    paid = t.orders.select(
        F.col("o_orderkey").alias("loan"), F.col("o_custkey").alias("account"), F.col("o_orderstatus").alias("family"),
        F.col("o_orderpriority").alias("source"), F.col("o_orderdate").cast("date").alias("paid_on"),
        cents("o_totalprice").alias("amount"),
    )
    owed = paid.select("account", "family", F.col("paid_on").alias("day"), F.col("amount").alias("debit"))
    holidays = literal_rows(t.spark, "holiday string", HOLIDAYS)
    return b.loan_production(paid, owed, holidays, REF).drop("product_key")


# --- activity score ------------------------------------------------------------------------------

CHANNELS = [("1-URGENT", "transfer"), ("2-HIGH", "order"), ("3-MEDIUM", "withdrawal"), ("4-NOT SPECIFIED", "cheque"), ("5-LOW", "card")]
_MONTH = f"CAST(o_orderdate AS DATE) BETWEEN DATE '2001-06-01' AND {R}"


def _month_flag(n: int) -> str:
    return (
        f"MAX(CASE WHEN o_totalprice >= 150000 AND date_trunc('month', o_orderdate) = date_trunc('month', {R} - INTERVAL {n} MONTH)"
        f" THEN 1 ELSE 0 END) AS flag_m_{n}"
    )


_RULES = """rules AS (
  SELECT i.v AS inflow_score, x.v AS transaction_score, d.v AS digital_score, e.v AS equipment_score,
    CAST(2 * (i.v + x.v + d.v + e.v) AS INT) AS level
  FROM (VALUES (0.0), (1.0)) AS i(v), (VALUES (0.0), (0.5), (1.0), (1.5)) AS x(v), (VALUES (0.0), (0.5)) AS d(v),
       (VALUES (0.0), (0.5), (1.0), (1.5)) AS e(v))"""


@query(
    "plan_activity_score",
    f"""WITH {_RULES}, channels(priority, channel) AS ({values_sql(CHANNELS)}),
flows AS (SELECT o_custkey AS customer, MAX(CAST(o_orderdate AS DATE)) AS last_day, MIN(CAST(o_orderdate AS DATE)) AS opened,
    {", ".join(_month_flag(n) for n in range(3))} FROM orders GROUP BY 1),
t AS (SELECT *, CAST(trunc({months_between_sql(R, "CAST(date_trunc('month', opened) + INTERVAL 1 MONTH AS DATE)")}) AS INT) AS tenure_months FROM flows),
used AS (SELECT o_custkey AS customer, LEAST(1.5, SUM(CASE channel WHEN 'card' THEN 1.0 ELSE 0.5 END)) AS score
  FROM (SELECT DISTINCT o_custkey, channel FROM orders JOIN channels ON priority = o_orderpriority WHERE {_MONTH}) AS x GROUP BY 1),
seen AS (SELECT DISTINCT o_custkey AS customer FROM orders WHERE {_MONTH} AND o_orderstatus = 'P'),
done AS (SELECT DISTINCT o_custkey AS customer FROM orders WHERE {_MONTH} AND o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')),
items AS (SELECT o_custkey AS customer, l_returnflag AS family, l_linenumber AS product, COUNT(DISTINCT l_orderkey) AS n
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3),
fams AS (SELECT customer, family, SUM(n) AS n FROM items GROUP BY 1, 2),
held AS (SELECT customer, LEAST(1.5, SUM(CASE WHEN n >= 2 THEN 1.0 WHEN n = 1 THEN 0.5 ELSE 0 END)) AS score FROM fams GROUP BY 1),
scored AS (
  SELECT t.customer, CAST({TENURE_SCORE} AS DECIMAL(9,1)) AS inflow_score, CAST(COALESCE(used.score, 0) AS DECIMAL(9,1)) AS transaction_score,
    CAST((CASE WHEN seen.customer IS NULL THEN 0 ELSE 0.5 END) + (CASE WHEN done.customer IS NULL THEN 0 ELSE 0.5 END) AS DECIMAL(9,1)) AS digital_score,
    CAST(COALESCE(held.score, 0) AS DECIMAL(9,1)) AS equipment_score
  FROM t LEFT JOIN used USING (customer) LEFT JOIN seen USING (customer) LEFT JOIN done USING (customer) LEFT JOIN held USING (customer))
SELECT customer, CAST(inflow_score AS DOUBLE) AS inflow_score, CAST(transaction_score AS DOUBLE) AS transaction_score,
  CAST(digital_score AS DOUBLE) AS digital_score, CAST(equipment_score AS DOUBLE) AS equipment_score, level
FROM scored LEFT JOIN rules USING (inflow_score, transaction_score, digital_score, equipment_score)""",
)
def plan_activity_score(t: Tables) -> DataFrame:
    """Rules cover digital scores up to 0.5 only, so some customers have no level."""
    day = F.col("o_orderdate").cast("date")
    month, this_month = F.trunc(day, "month"), F.trunc(F.lit(REF).cast("date"), "month")
    reached = F.col("o_totalprice") >= 150000
    flags = t.orders.groupBy(F.col("o_custkey").alias("customer")).agg(
        F.min(day).alias("opened"),
        *[F.max((reached & (month == F.add_months(this_month, -n))).cast("int")).alias(f"flag_m_{n}") for n in range(3)],
    )
    events = t.orders.select(F.col("o_custkey").alias("customer"), day.alias("day"), "o_orderpriority", "o_orderstatus")
    channels = literal_rows(t.spark, "o_orderpriority string, channel string", CHANNELS)
    owners = t.orders.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("customer"))
    items = t.lineitem.select(
        F.col("l_orderkey").alias("contract"), F.col("l_returnflag").alias("family"), F.col("l_linenumber").alias("product")
    )
    holdings = dealt(items, "contract").join(dealt(owners, "contract"), "contract")
    steps = [0.0, 0.5, 1.0, 1.5]
    rules = [(i, x, d, e, int(2 * (i + x + d + e))) for i in (0.0, 1.0) for x in steps for d in (0.0, 0.5) for e in steps]
    schema = ", ".join([*(f"{score} double" for score in sc.SCORES), "level int"])
    return sc.activity_score(
        flags, events.join(channels, "o_orderpriority"), events.where("o_orderstatus = 'P'"),
        events.where("o_orderstatus = 'F'").withColumnRenamed("o_orderpriority", "kind"),
        holdings, literal_rows(t.spark, schema, rules), REF,
        kinds=["1-URGENT", "2-HIGH"], families=["A", "N", "R"],
    )


@query(
    "plan_equipment_objectives",
    f"""WITH {SEASON}, targets AS (
  SELECT s_suppkey, CAST(1995 + s_suppkey % 7 AS INT) AS year, u.product, u.annual FROM supplier, LATERAL (VALUES
    ('cards', CAST(CASE WHEN s_acctbal > 0 THEN s_acctbal END AS DECIMAL(18,2))), ('packs', CAST(s_acctbal * 2 AS DECIMAL(18,2)))) AS u(product, annual)
  WHERE u.annual IS NOT NULL),
split AS (SELECT targets.*, week, CASE WHEN week <= 26 THEN CASE WHEN week <= 13 THEN 1 ELSE 2 END ELSE CASE WHEN week <= 39 THEN 3 ELSE 4 END END AS quarter,
  round(annual * CAST(pct_week AS DECIMAL(9,4)), 2) AS weekly FROM targets JOIN season ON season.year = targets.year)
SELECT s_suppkey, year, product, week, CAST(quarter AS INT) AS quarter, CAST(weekly AS DOUBLE) AS weekly,
  CAST(SUM(weekly) OVER (PARTITION BY s_suppkey, product, quarter) AS DOUBLE) AS quarterly FROM split""",
)
def plan_equipment_objectives(t: Tables) -> DataFrame:
    balance = F.col("s_acctbal")
    wide = t.supplier.select(
        "s_suppkey", (F.lit(1995) + F.col("s_suppkey") % 7).cast("int").alias("year"),
        F.when(balance > 0, balance).cast("decimal(18,2)").alias("cards"),
        (balance * 2).cast("decimal(18,2)").alias("packs"),
    )
    split = b.equipment_objectives(wide, season(t), ["s_suppkey", "year"])
    return split.select("s_suppkey", "year", "product", "week", "quarter", "weekly", "quarterly")


@query(
    "plan_monthly_report",
    f"""WITH {RATES}, {LINES}, home AS (
  SELECT l_partkey % 10 AS class, day, CASE WHEN side = 'C' THEN amount_home END AS credit, CASE WHEN side = 'D' THEN amount_home END AS debit, o_custkey
  FROM (SELECT l_partkey, o_custkey, side, lines.day, CASE WHEN lines.currency = '1-URGENT' THEN CAST(amount AS DECIMAL(38,4))
      WHEN kind = 'VIREMENT' THEN CAST(amount * mid AS DECIMAL(38,4))
      ELSE CAST(amount * CAST((low + high) * 0.5 AS DECIMAL(12,4)) AS DECIMAL(38,4)) END AS amount_home
    FROM lines LEFT JOIN rates ON rates.currency = lines.currency AND rates.quote_date = lines.day) AS x),
n AS (SELECT o_custkey, strftime(day, '%Y%m') AS month, COUNT(*) AS occurrences FROM home GROUP BY 1, 2),
s AS (SELECT o_custkey, strftime(day, '%Y%m') AS month, class, SUM(debit) AS debit, SUM(credit) AS credit FROM home GROUP BY 1, 2, 3)
SELECT o_custkey, month, class, CAST(debit AS DOUBLE) AS debit_monthly, CAST(credit AS DOUBLE) AS credit_monthly,
  CAST(occurrences AS BIGINT) AS occurrences
FROM s JOIN n USING (o_custkey, month) WHERE COALESCE(debit, 0) <> 0 OR COALESCE(credit, 0) <> 0""",
)
def plan_monthly_report(t: Tables) -> DataFrame:
    """Converted balances per customer, class and month."""
    home = m.convert_amounts(
        lines(t), rates(t), ["amount"], home="1-URGENT", wire_kind=WIRE_KIND, on_date="day", spread_by=["l_orderkey"]
    ).select(
        "o_custkey", (F.col("l_partkey") % 10).alias("class"), "day",
        F.when(F.col("side") == "D", F.col("amount_home")).alias("debit"),
        F.when(F.col("side") == "C", F.col("amount_home")).alias("credit"),
    )
    return m.monthly_balance(home, ["o_custkey"], ["class"], "day", ["debit", "credit"])
