"""Money: netting, classes, rates, conversion, flows, monthly balances, positions.

Line items are movements or balances: ``l_returnflag`` R/A/N stands for the account
sides PP/AA/AP, ``l_linestatus`` O/F for wire and cash, ``o_orderpriority`` for the
currency (``1-URGENT`` is the home currency).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import CASH_KIND, LABELS, LINE_CLASSES, ORACLES, REF, WIRE_KIND, Tables, cents, literal_rows, query, values_sql
from tidemark.operators import money as m
from tidemark.operators import comparison as c

PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
SIDE = "CASE l_returnflag WHEN 'R' THEN 'PP' WHEN 'A' THEN 'AA' ELSE CASE WHEN l_linenumber = 7 THEN NULL ELSE 'AP' END END"

# Balances per order line: odd quantities are debits, even ones credits; the last
# line number has no known side.
BALANCES = f"""WITH balances AS (
  SELECT l_orderkey, l_linenumber, l_partkey, {SIDE} AS side,
    CASE WHEN CAST(l_quantity AS INT) % 2 = 1 THEN {PRICE} - 20000 END AS debit,
    CASE WHEN CAST(l_quantity AS INT) % 2 = 0 OR l_linenumber = 1 THEN {PRICE} - 20000 END AS credit
  FROM lineitem)
"""


def balances(t: Tables) -> DataFrame:
    odd = F.col("l_quantity").cast("int") % 2 == 1
    amount = cents("l_extendedprice") - 20000
    side = (
        F.when(F.col("l_returnflag") == "R", "PP")
        .when(F.col("l_returnflag") == "A", "AA")
        .when(F.col("l_linenumber") != 7, "AP")
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", side.alias("side"),
        F.when(odd, amount).alias("debit"),
        F.when(~odd | (F.col("l_linenumber") == 1), amount).alias("credit"),
    )


_NET = """CASE WHEN side = 'AA' THEN COALESCE(debit, 0) - COALESCE(credit, 0)
     WHEN side = 'AP' AND debit >= 0 THEN debit END AS debit,
CASE WHEN side = 'PP' THEN COALESCE(credit, 0) - COALESCE(debit, 0)
     WHEN side = 'AP' AND credit >= 0 THEN credit END AS credit"""
_NETTED = BALANCES + f", netted AS (SELECT l_orderkey, l_linenumber, l_partkey, side, {_NET} FROM balances)\n"
_AMOUNTS = "CAST(debit AS DOUBLE) AS debit, CAST(credit AS DOUBLE) AS credit"


@query("money_net_by_side", _NETTED + f"SELECT l_orderkey, l_linenumber, l_partkey, side, {_AMOUNTS} FROM netted")
def money_net_by_side(t: Tables) -> DataFrame:
    return m.net_by_side(balances(t), "debit", "credit", "side")


@query(
    "money_classify_balances",
    _NETTED + f"""SELECT l_orderkey, l_linenumber, l_partkey, side, {_AMOUNTS},
  CAST(debit * 2 AS DOUBLE) AS debit_home, CAST(credit * 2 AS DOUBLE) AS credit_home,
  CASE WHEN side = 'AA' THEN 'EMPLOI' WHEN side = 'PP' THEN 'RESSOURCE'
       WHEN side = 'AP' AND credit >= 0 THEN 'RESSOURCE' WHEN side = 'AP' AND debit >= 0 THEN 'EMPLOI' END AS category
FROM netted""",
)
def money_classify_balances(t: Tables) -> DataFrame:
    doubled = balances(t).withColumns(
        {"debit_home": F.col("debit") * 2, "credit_home": F.col("credit") * 2}
    )
    return m.classify_balances(doubled, [("debit", "credit"), ("debit_home", "credit_home")], "side", LABELS)


_CLASS_CASE = "CASE " + " ".join(
    f"WHEN starts_with(line, '{prefix}') THEN '{LINE_CLASSES[prefix]}'"
    for prefix in sorted(LINE_CLASSES, key=lambda p: -len(p))
) + " ELSE 'OTHER' END"


@query(
    "money_prefix_classes",
    f"""WITH lines AS (
  SELECT l_suppkey, CAST(l_partkey AS VARCHAR) AS line, 'IN' AS category FROM lineitem
  UNION
  SELECT l_suppkey, CAST(l_orderkey AS VARCHAR), 'OUT' FROM lineitem WHERE l_returnflag <> 'N')
SELECT l_suppkey, line, category, {_CLASS_CASE} AS class FROM lines""",
)
def money_prefix_classes(t: Tables) -> DataFrame:
    """Classes by the leading digits of the part and order numbers."""
    coded = t.lineitem.select(
        "l_suppkey",
        F.col("l_partkey").cast("string").alias("credit_line"),
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey").cast("string")).alias("debit_line"),
    )
    return m.classify_prefix(
        coded, ["l_suppkey"], "credit_line", "debit_line", LINE_CLASSES, "OTHER", ("IN", "OUT")
    )


# --- rates: quotes per priority ("currency") and day, taken from the orders ---------------

WIRE = """wire AS (
  SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS quote_date,
         MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS mid, MIN(o_orderkey % 7) + 1 AS unit
  FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM') GROUP BY 1, 2)"""
CASH = """cash AS (
  SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS quote_date,
         MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS sell, MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS buy,
         MIN(o_orderkey % 5) AS unit
  FROM orders WHERE o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') GROUP BY 1, 2)"""
CURRENCIES = [
    ("1-URGENT", "home"), ("2-HIGH", "high"), ("3-MEDIUM", "medium"), ("4-NOT SPECIFIED", "none"),
]


def wire(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderpriority").isin("2-HIGH", "3-MEDIUM"))
    return rows.groupBy(
        F.col("o_orderpriority").alias("currency"), F.col("o_orderdate").cast("date").alias("quote_date")
    ).agg(F.max(cents("o_totalprice")).alias("mid"), (F.min(F.col("o_orderkey") % 7) + 1).alias("unit"))


def cash(t: Tables) -> DataFrame:
    rows = t.orders.where(F.col("o_orderpriority").isin("3-MEDIUM", "4-NOT SPECIFIED"))
    return rows.groupBy(
        F.col("o_orderpriority").alias("currency"), F.col("o_orderdate").cast("date").alias("quote_date")
    ).agg(
        F.max(cents("o_totalprice")).alias("sell"), F.min(cents("o_totalprice")).alias("buy"),
        F.min(F.col("o_orderkey") % 5).alias("unit"),
    )


def currencies(t: Tables) -> DataFrame:
    return literal_rows(t.spark, "currency string, label string", CURRENCIES)


def _doubles(df: DataFrame, *cols: str) -> DataFrame:
    """The quotes as doubles, so that divisions agree with SQL to the last bit."""
    return df.withColumns({col: F.col(col).cast("double") for col in cols})


@query(
    "money_unit_rates",
    f"""WITH {CASH} SELECT currency, CAST(quote_date AS VARCHAR) AS quote_date,
  CAST(sell AS DOUBLE) AS sell, CAST(buy AS DOUBLE) AS buy, unit,
  CASE WHEN unit <> 0 THEN (CAST(sell AS DOUBLE) + CAST(buy AS DOUBLE) / 2) / unit END AS rate FROM cash""",
)
def money_unit_rates(t: Tables) -> DataFrame:
    return m.unit_rates(_doubles(cash(t), "sell", "buy"), sell="sell", buy="buy")


@query(
    "money_unit_mid",
    f"""WITH {WIRE} SELECT currency, CAST(quote_date AS VARCHAR) AS quote_date,
  CAST(mid AS DOUBLE) AS mid, unit, CAST(mid AS DOUBLE) / unit AS rate FROM wire""",
)
def money_unit_mid(t: Tables) -> DataFrame:
    return m.unit_rates(_doubles(wire(t), "mid"), mid="mid")


_LAST = "WHERE quote_date = (SELECT MAX(quote_date) FROM {0} AS x WHERE x.currency = {0}.currency)"


@query(
    "money_rate_table",
    f"""WITH {WIRE}, {CASH}, cur(currency, label) AS ({values_sql(CURRENCIES)}),
w AS (SELECT * FROM wire {_LAST.format('wire')}), k AS (SELECT * FROM cash {_LAST.format('cash')})
SELECT cur.currency, label, CAST(COALESCE(w.quote_date, k.quote_date) AS VARCHAR) AS quote_date,
  CAST(mid AS DOUBLE) / w.unit AS mid, CASE WHEN k.unit <> 0 THEN CAST(buy AS DOUBLE) / k.unit END AS low,
  CASE WHEN k.unit <> 0 THEN CAST(sell AS DOUBLE) / k.unit END AS high
FROM cur LEFT JOIN w ON w.currency = cur.currency LEFT JOIN k ON k.currency = cur.currency""",
)
def money_rate_table(t: Tables) -> DataFrame:
    """Reference currencies with their latest quotes."""
    from tidemark.operators.latest import latest_by

    last_wire = latest_by(_doubles(wire(t), "mid"), "currency", "quote_date")
    last_cash = latest_by(_doubles(cash(t), "sell", "buy"), "currency", "quote_date")
    return m.rate_table(currencies(t), last_wire, last_cash)


_HISTORY = f"""WITH {WIRE}, {CASH}, cur(currency, label) AS ({values_sql(CURRENCIES)}),
history AS (
  SELECT w.currency, w.quote_date, label, CAST(mid AS DOUBLE) / w.unit AS mid,
    CASE WHEN k.unit <> 0 THEN CAST(buy AS DOUBLE) / k.unit END AS low,
    CASE WHEN k.unit <> 0 THEN CAST(sell AS DOUBLE) / k.unit END AS high
  FROM wire AS w LEFT JOIN cash AS k ON k.currency = w.currency AND k.quote_date = w.quote_date
  LEFT JOIN cur ON cur.currency = w.currency)
"""


def history(t: Tables) -> DataFrame:
    return m.rate_history(currencies(t), _doubles(wire(t), "mid"), _doubles(cash(t), "sell", "buy"))


@query(
    "money_rate_history",
    _HISTORY + "SELECT currency, CAST(quote_date AS VARCHAR) AS quote_date, label, mid, low, high FROM history",
)
def money_rate_history(t: Tables) -> DataFrame:
    return history(t)


@query(
    "money_tagged_rates",
    f"""WITH {WIRE}, {CASH}
SELECT currency, CAST(quote_date AS VARCHAR) AS quote_date, CAST(mid AS DOUBLE) AS rate, 'VIREMENT' AS quote_type FROM wire
UNION SELECT currency, CAST(quote_date AS VARCHAR), CAST(sell AS DOUBLE), 'BILLET' FROM cash""",
)
def money_tagged_rates(t: Tables) -> DataFrame:
    quotes = ["currency", "quote_date"]
    return m.tagged_rates(
        wire(t).select(*quotes, F.col("mid").alias("rate")),
        cash(t).select(*quotes, F.col("sell").alias("rate")),
        (WIRE_KIND, CASH_KIND),
    )


# Rates with two decimals, so that a product of decimals is exact in both engines.
RATES = """rates AS (
  SELECT o_orderpriority AS currency, CAST(o_orderdate AS DATE) AS quote_date,
    CAST(MAX(o_orderkey % 1000) / 100.0 AS DECIMAL(9,2)) AS mid,
    CAST(MIN(o_orderkey % 900) / 100.0 AS DECIMAL(9,2)) AS low,
    CAST(MAX(o_orderkey % 900) / 100.0 AS DECIMAL(9,2)) AS high
  FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1, 2)"""


def rates(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")

    def hundredths(column):
        return (column.cast("decimal(9,2)") / 100).cast("decimal(9,2)")

    return (
        t.orders.where("o_orderpriority <> '1-URGENT'")
        .groupBy(
            F.col("o_orderpriority").alias("currency"),
            F.col("o_orderdate").cast("date").alias("quote_date"),
        )
        .agg(
            hundredths(F.max(key % 1000)).alias("mid"),
            hundredths(F.min(key % 900)).alias("low"),
            hundredths(F.max(key % 900)).alias("high"),
        )
    )


LINES = f"""lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, o_orderpriority AS currency,
    CASE l_linestatus WHEN 'O' THEN 'VIREMENT' ELSE 'BILLET' END AS kind,
    CAST(l_shipdate AS DATE) AS day, {PRICE} AS amount,
    CASE l_returnflag WHEN 'R' THEN 'D' ELSE 'C' END AS side
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def lines(t: Tables) -> DataFrame:
    orders = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.col("o_orderpriority").alias("currency")
    )
    return t.lineitem.join(orders, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "currency",
        F.when(F.col("l_linestatus") == "O", "VIREMENT").otherwise("BILLET").alias("kind"),
        F.col("l_shipdate").cast("date").alias("day"),
        cents("l_extendedprice").alias("amount"),
        F.when(F.col("l_returnflag") == "R", "D").otherwise("C").alias("side"),
    )


_CONVERTED = """SELECT l_orderkey, l_linenumber, l_partkey, lines.currency, kind, CAST(amount AS DOUBLE) AS amount,
  CAST(CASE WHEN lines.currency = '1-URGENT' THEN amount
            WHEN kind = 'VIREMENT' THEN CAST(amount * mid AS DECIMAL(38,4))
            ELSE CAST(amount * CAST((low + high) * 0.5 AS DECIMAL(12,4)) AS DECIMAL(38,4)) END AS DOUBLE) AS amount_home
FROM lines LEFT JOIN """


@query(
    "money_convert",
    f"""WITH {RATES}, {LINES}, last AS (
  SELECT currency, arg_max(mid, quote_date) AS mid, arg_max(low, quote_date) AS low, arg_max(high, quote_date) AS high
  FROM rates GROUP BY 1)
""" + _CONVERTED + "last ON last.currency = lines.currency",
)
def money_convert(t: Tables) -> DataFrame:
    """At the latest rates."""
    from tidemark.operators.latest import latest_by

    latest = latest_by(rates(t), "currency", "quote_date")
    out = m.convert_amounts(lines(t), latest, ["amount"], home="1-URGENT", wire_kind=WIRE_KIND, spread_by=["l_orderkey"])
    return out.drop("o_custkey", "day", "side")


@query(
    "money_convert_by_day",
    f"WITH {RATES}, {LINES}\n" + _CONVERTED
    + "rates ON rates.currency = lines.currency AND rates.quote_date = lines.day",
)
def money_convert_by_day(t: Tables) -> DataFrame:
    """At the rates of the day; unknown where there is no quote."""
    out = m.convert_amounts(
        lines(t), rates(t), ["amount"], home="1-URGENT", wire_kind=WIRE_KIND, on_date="day", spread_by=["l_orderkey"]
    )
    return out.drop("o_custkey", "day", "side")


_FILLED = """spine AS (
  SELECT currency, CAST(g.d AS DATE) AS quote_date FROM (SELECT DISTINCT currency FROM rates) AS t,
    generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY) AS g(d)),
filled AS (
  SELECT spine.currency, spine.quote_date, """ + ", ".join(
    f"COALESCE(first_value({q} IGNORE NULLS) OVER ahead, last_value({q} IGNORE NULLS) OVER behind) AS {q}"
    for q in ("mid", "low", "high")
) + """
  FROM spine LEFT JOIN rates ON rates.currency = spine.currency AND rates.quote_date = spine.quote_date
  WINDOW ahead AS (PARTITION BY spine.currency ORDER BY spine.quote_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         behind AS (PARTITION BY spine.currency ORDER BY spine.quote_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(
    "money_convert_filled",
    f"WITH {RATES}, {LINES}, {_FILLED}\n" + _CONVERTED
    + "filled ON filled.currency = lines.currency AND filled.quote_date = lines.day",
)
def money_convert_filled(t: Tables) -> DataFrame:
    """At the rates of the day, days without a quote taking the next known one."""
    daily = m.fill_rates(rates(t), "1995-01-01", "2001-12-31")
    out = m.convert_amounts(
        lines(t), daily, ["amount"], home="1-URGENT", wire_kind=WIRE_KIND, on_date="day", spread_by=["l_orderkey"]
    )
    return out.drop("o_custkey", "day", "side")


@query("money_convert_asof", ORACLES["money_convert_filled"])
def money_convert_asof(t: Tables) -> DataFrame:
    """The same without a row for every currency and day; all currencies are cut in ranges."""
    out = m.convert_amounts_asof(
        lines(t), rates(t), ["amount"], home="1-URGENT", wire_kind=WIRE_KIND, on_date="day", hot_rows=1_000
    )
    return out.drop("o_custkey", "day", "side")


# --- flows -----------------------------------------------------------------------------------

_RATE = "CASE WHEN lines.currency = '1-URGENT' THEN 1 ELSE mid END"
_FLOW = f"""WITH {RATES}, {LINES}, flows AS (
  SELECT o_custkey AS account, lines.day, amount, amount * {_RATE} / 100 AS home
  FROM lines LEFT JOIN rates ON rates.currency = lines.currency AND rates.quote_date = lines.day WHERE side = 'C')
"""


@query(
    "flow_credit",
    f"""WITH {RATES}, {LINES}
SELECT o_custkey AS account,
  CAST(SUM(COALESCE(CAST(amount * {_RATE} AS DECIMAL(30,4)), 0)) AS DOUBLE) / 100 AS credit_flow
FROM lines LEFT JOIN rates ON rates.currency = lines.currency AND rates.quote_date = lines.day
WHERE side = 'C' GROUP BY 1""",
)
def flow_credit(t: Tables) -> DataFrame:
    flow = m.credit_flow(
        lines(t), rates(t), "o_custkey", "day", "currency", "amount", "side", home="1-URGENT"
    )
    # the exact sum in hundredths, divided as a double as in SQL
    hundredths = (F.col("credit_flow") * 100).cast("decimal(30,4)").cast("double")
    return flow.select("account", (hundredths / 100).alias("credit_flow"))


@query(
    "flow_month_flags",
    f"""WITH {RATES}, {LINES}, flows AS (
  SELECT o_custkey AS account, lines.day, CAST(amount * {_RATE} AS DECIMAL(30,4)) AS home,
    (2001 - year(lines.day)) * 12 + 6 - month(lines.day) AS back
  FROM lines LEFT JOIN rates ON rates.currency = lines.currency AND rates.quote_date = lines.day WHERE side = 'C')
SELECT account, CAST(SUM(CASE WHEN back = 0 THEN COALESCE(home, 0) ELSE 0 END) AS DOUBLE) / 100 AS month_total,
  MAX(CASE WHEN back = 0 AND home >= 200000 THEN 1 ELSE 0 END) AS flag_m_0,
  MAX(CASE WHEN back = 1 AND home >= 200000 THEN 1 ELSE 0 END) AS flag_m_1,
  MAX(CASE WHEN back = 2 AND home >= 200000 THEN 1 ELSE 0 END) AS flag_m_2
FROM flows WHERE back BETWEEN 0 AND 2 GROUP BY 1""",
)
def flow_month_flags(t: Tables) -> DataFrame:
    flow = m.monthly_flow_flags(
        lines(t), rates(t), REF, "o_custkey", "day", "currency", "amount", "side", home="1-URGENT"
    )
    hundredths = (F.col("month_total") * 100).cast("decimal(30,4)").cast("double")
    return flow.withColumn("month_total", hundredths / 100)


_BOUNDS = {
    "s": "date_trunc('week', {r})", "s_1": "date_trunc('week', {r} - INTERVAL 7 DAY)",
    "m": "date_trunc('month', {r})", "m_1": "date_trunc('month', {r} - INTERVAL 1 MONTH)",
    "m_2": "date_trunc('month', {r} - INTERVAL 2 MONTH)", "t": "date_trunc('quarter', {r})",
    "t_1": "date_trunc('quarter', date_trunc('quarter', {r}) - INTERVAL 1 DAY)",
    "y": "date_trunc('year', {r})", "y_1": "date_trunc('quarter', date_trunc('year', {r}) - INTERVAL 1 DAY)",
}


@query(
    "flow_since_bounds",
    f"""WITH per_order AS (
  SELECT l_orderkey, """ + ", ".join(
        f"SUM(CASE WHEN l_shipdate >= {b.format(r=f'DATE {chr(39)}{REF}{chr(39)}')} THEN {PRICE} ELSE 0 END) AS sum_{n}"
        for n, b in _BOUNDS.items()
    ) + """ FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT o_custkey, """ + ", ".join(f"CAST(SUM(sum_{n}) AS DOUBLE) AS sum_{n}" for n in _BOUNDS)
    + " FROM orders LEFT JOIN per_order ON l_orderkey = o_orderkey GROUP BY 1",
)
def flow_since_bounds(t: Tables) -> DataFrame:
    credits = t.lineitem.where("l_returnflag <> 'R'")
    sums = m.sums_since(
        credits, "l_orderkey", "l_shipdate", cents("l_extendedprice"), m.since_bounds(REF)
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    return m.roll_up(sums, t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey")


_MONTHLY = f"""WITH balances AS (
  SELECT l_suppkey, l_returnflag, CAST(l_shipdate AS DATE) AS day,
    CASE WHEN CAST(l_quantity AS INT) % 2 = 1 THEN {PRICE} END AS debit,
    CASE WHEN CAST(l_quantity AS INT) % 4 = 0 THEN {PRICE} END AS credit
  FROM lineitem)
"""


def monthly_input(t: Tables) -> DataFrame:
    quantity, price = F.col("l_quantity").cast("int"), cents("l_extendedprice")
    return t.lineitem.select(
        "l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("day"),
        F.when(quantity % 2 == 1, price).alias("debit"),
        F.when(quantity % 4 == 0, price).alias("credit"),
    )


@query(
    "flow_monthly_balance",
    _MONTHLY + """, n AS (SELECT l_suppkey, strftime(day, '%Y%m') AS month, COUNT(*) AS occurrences FROM balances GROUP BY 1, 2),
s AS (SELECT l_suppkey, strftime(day, '%Y%m') AS month, l_returnflag, SUM(debit) AS debit, SUM(credit) AS credit
      FROM balances GROUP BY 1, 2, 3)
SELECT l_suppkey, month, l_returnflag, CAST(debit AS DOUBLE) AS debit_monthly,
  CAST(credit AS DOUBLE) AS credit_monthly, CAST(occurrences AS BIGINT) AS occurrences
FROM s JOIN n USING (l_suppkey, month)
WHERE NOT ((debit IS NULL OR debit = 0) AND (credit IS NULL OR credit = 0))""",
)
def flow_monthly_balance(t: Tables) -> DataFrame:
    return m.monthly_balance(monthly_input(t), ["l_suppkey"], ["l_returnflag"], "day", ["debit", "credit"])


@query(
    "flow_monthly_balance_dense",
    _MONTHLY + f""", expected AS (SELECT CAST(g.d AS DATE) AS day
  FROM generate_series(DATE '2001-01-01', DATE '{REF}', INTERVAL 1 DAY) AS g(d)),
seen AS (SELECT DISTINCT day FROM balances),
spine AS (SELECT expected.day AS expected_day, last_value(seen.day IGNORE NULLS) OVER (ORDER BY expected.day
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS actual_day
          FROM expected LEFT JOIN seen ON seen.day = expected.day)
SELECT l_suppkey, strftime(expected_day, '%Y%m') AS month, l_returnflag,
  CAST(SUM(debit) AS DOUBLE) AS debit_monthly, CAST(SUM(credit) AS DOUBLE) AS credit_monthly,
  CAST(MAX(day(last_day(expected_day))) AS INT) AS occurrences
FROM balances LEFT JOIN spine ON actual_day = day GROUP BY 1, 2, 3""",
)
def flow_monthly_balance_dense(t: Tables) -> DataFrame:
    return m.monthly_balance_dense(
        monthly_input(t), REF, ["l_suppkey"], ["l_returnflag"], "day", ["debit", "credit"]
    )


@query(
    "position_value",
    f"""WITH positions AS (
  SELECT o_custkey, l_partkey AS security, SUM(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * CAST(l_quantity AS DECIMAL(18,2))) AS quantity
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
quotes AS (SELECT l_partkey AS security, CAST(l_shipdate AS DATE) AS quote_date, MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
  FROM lineitem GROUP BY 1, 2),
latest AS (SELECT security, CASE WHEN security IN (7, 8) THEN 0 ELSE arg_max(price, quote_date) END AS price FROM quotes GROUP BY 1)
SELECT o_custkey, security, CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price,
  CAST(round(quantity * price, 2) AS DOUBLE) AS value
FROM positions JOIN latest USING (security) WHERE quantity > 0 AND price > 0""",
)
def position_value(t: Tables) -> DataFrame:
    """Net quantities per customer and part, at the part's last known price."""
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    signed = F.when(F.col("l_returnflag") == "R", -1).otherwise(1) * cents("l_quantity")
    positions = t.lineitem.join(owners, "l_orderkey").select(
        "o_custkey", F.col("l_partkey").alias("security"), signed.alias("quantity")
    )
    isin = F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("isin")
    quotes = t.lineitem.select(
        isin, F.col("l_shipdate").cast("date").alias("quote_date"),
        cents("l_extendedprice").alias("price"),
    )
    part_isin = F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("isin")
    securities = t.part.select(F.col("p_partkey").alias("security"), part_isin)
    return m.value_positions(
        positions, securities, quotes, "o_custkey", priced_at_zero=["P7", "P8"]
    )


@query(
    "flow_variation_of_balance",
    f"""WITH daily AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS day, SUM({PRICE}) AS amount FROM lineitem GROUP BY 1, 2),
m AS (SELECT l_suppkey, SUM(CASE WHEN day = DATE '{REF}' THEN amount END) AS now,
  (MAX(CASE WHEN date_trunc('month', day) = DATE '2001-05-01' THEN struct_pack(d := day, v := amount) END)).v AS base
  FROM daily GROUP BY 1)
SELECT l_suppkey, CAST(COALESCE(now, 0) - COALESCE(base, 0) AS DOUBLE) AS variation FROM m
WHERE now IS NOT NULL OR base IS NOT NULL""",
)
def flow_variation_of_balance(t: Tables) -> DataFrame:
    """Difference with missing sides counted as 0, on the aggregation form."""
    daily = c.daily_totals(t.lineitem, "l_suppkey", "l_shipdate", {"amount": cents("l_extendedprice")})
    now = c.values_as_of(daily, "amount", REF, [("month", 1)], "l_suppkey", "day")
    change = c.difference(F.col("amount"), F.col("last_month_amount"), "zero")
    return now.select("l_suppkey", change.alias("variation"))
