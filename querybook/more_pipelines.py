"""Pipelines on holdings and accounts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import REF, Tables, cents, literal_rows, query, values_sql
from querybook.flags import active_at, flags_sql, in_period
from querybook.shaping import _CRC_STEP
from tidemark.functions import periods as p
from tidemark.operators.comparison import past_name
from tidemark.operators.joins import dealt
from tidemark.plans import accounts as a
from tidemark.plans import holdings as h
from tidemark.plans.credits import loan_commitments
from tidemark.plans.dimensions import contract_graph, segment_dimension
from tidemark.plans.equipment import customer_equipment

R = f"DATE '{REF}'"
SEGMENT_DATE = "1998-01-03"


def _rolled(name: str, predicate, source: str, key: str) -> str:
    return f"(SELECT {key}, " + flags_sql(name, predicate, "MAX(CAST({} AS INT))") + f" FROM {source} GROUP BY ALL)"


def _filled(alias: str, name: str) -> str:
    return ", ".join(f"COALESCE({alias}.{flag}, 0) AS {flag}" for flag in p.flag_names(name))


@query(
    "plan_savings_flags",
    f"""WITH accounts AS (SELECT o_orderkey AS account, o_custkey AS customer, o_orderpriority AS kind, CAST(o_orderdate AS DATE) AS opened FROM orders),
history AS (SELECT account, customer, kind, l_linestatus || l_returnflag AS state, CAST(l_shipdate AS DATE) AS snapshot
  FROM lineitem JOIN accounts ON account = l_orderkey),
alive AS (SELECT * FROM history WHERE state <> 'FR'),
is_open AS {_rolled('open', in_period('snapshot', REF), 'alive', 'account')},
lonely AS (SELECT customer, snapshot FROM alive GROUP BY 1, 2 HAVING MIN(CAST(kind IN ('1-URGENT', '5-LOW') AS INT)) = 1),
lone AS {_rolled('savings_only', in_period('snapshot', REF), 'lonely', 'customer')},
rich AS (SELECT l_orderkey AS account, CAST(l_shipdate AS DATE) AS snapshot FROM lineitem WHERE l_extendedprice >= 50000),
funded AS {_rolled('funded', in_period('snapshot', REF), 'rich', 'account')}
SELECT accounts.account, accounts.customer, kind, {flags_sql('subscribed', in_period('opened', REF))},
  {_filled('is_open', 'open')}, {_filled('lone', 'savings_only')}, {_filled('funded', 'funded')}
FROM accounts LEFT JOIN is_open USING (account) LEFT JOIN lone ON lone.customer = accounts.customer LEFT JOIN funded USING (account)
WHERE kind IN ('1-URGENT', '5-LOW')""",
)
def plan_savings_flags(t: Tables) -> DataFrame:
    accounts = t.orders.select(
        F.col("o_orderkey").alias("account"), F.col("o_custkey").alias("customer"),
        F.col("o_orderpriority").alias("kind"), F.col("o_orderdate").alias("opened"),
    )
    history = t.lineitem.select(
        F.col("l_orderkey").alias("account"), F.concat("l_linestatus", "l_returnflag").alias("state"),
        F.col("l_shipdate").cast("date").alias("snapshot"),
    ).join(accounts.drop("opened"), "account")
    balances = t.lineitem.select(
        F.col("l_orderkey").alias("account"), F.col("l_shipdate").alias("snapshot"),
        F.col("l_extendedprice").alias("credit"),
    )
    flagged = h.savings_flags(accounts, history, balances, REF, ["1-URGENT", "5-LOW"], "FR", 50000)
    return flagged.drop("opened")


@query(
    "plan_overdraft_flags",
    f"""WITH agreed AS (
  SELECT o_orderkey AS number, o_custkey AS account, o_orderstatus AS state, CAST(o_orderdate AS DATE) AS since, CAST(l_shipdate AS DATE) AS until
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
granted AS (SELECT * FROM agreed WHERE state = 'O'),
notified AS {_rolled('notified', active_at('since', 'until', REF), 'granted', 'number')},
drawn AS (SELECT o_custkey AS account, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_totalprice - 200000 > 0),
used AS {_rolled('used', in_period('day', REF), 'drawn', 'account')},
base AS {_rolled('subscribed', in_period('since', REF), 'agreed', 'number, account')}
SELECT base.*, {_filled('notified', 'notified')}, """
    + ", ".join(
        f"COALESCE(used.{u}, 0) * COALESCE(notified.{n}, 0) AS {u}"
        for u, n in zip(p.flag_names("used"), p.flag_names("notified"), strict=True)
    )
    + " FROM base LEFT JOIN notified USING (number) LEFT JOIN used ON used.account = base.account",
)
def plan_overdraft_flags(t: Tables) -> DataFrame:
    ends = dealt(t.lineitem.select(F.col("l_orderkey").alias("number"), F.col("l_shipdate").alias("until")), "number")
    orders = t.orders.select(
        F.col("o_orderkey").alias("number"), F.col("o_custkey").alias("account"),
        F.col("o_orderstatus").alias("state"), F.col("o_orderdate").alias("since"),
    )
    agreed = dealt(orders, "number").join(ends, "number")
    balances = t.orders.select(
        F.col("o_custkey").alias("account"), F.col("o_orderdate").alias("day"),
        (F.col("o_totalprice") - 200000).alias("debit"),
    )
    return h.overdraft_flags(agreed, balances, REF, "O")


_INSURED = [("week", 1), ("week", 2), ("month", 1), ("month", 2), ("quarter", 1), ("year", 1)]


def _past(unit: str, n: int) -> str:
    span = f"{7 * n} DAY" if unit == "week" else f"{ {'month': 1, 'quarter': 3, 'year': 12}[unit] * n} MONTH"
    inside = f"date_trunc('{unit}', day) = date_trunc('{unit}', {R} - INTERVAL {span})"
    return (
        f"COALESCE(arg_max(CASE WHEN {inside} THEN amount END, CASE WHEN {inside} THEN day END), 0)"
        f" AS {past_name('amount', unit, n)}"
    )


@query(
    "plan_insurance_outstanding",
    f"""WITH contracts AS (SELECT s_suppkey AS contract, s_nationkey AS account, CASE WHEN s_acctbal > 5000 THEN 'R' ELSE 'A' END AS product,
    s_acctbal AS since FROM supplier WHERE s_acctbal > 0),
reported AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'first' ELSE 'second' END AS insurer, l_suppkey AS contract, CAST(l_shipdate AS DATE) AS day,
    l_extendedprice AS amount, CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_returnflag END AS reported FROM lineitem),
daily AS (SELECT insurer, account, reported.contract, product, since, day, MAX(amount) AS amount
  FROM reported JOIN contracts USING (contract) WHERE reported IS NULL OR reported = product GROUP BY ALL),
now AS (SELECT insurer, account, contract, product, since, MAX(CASE WHEN day = {R} THEN amount END) AS amount,
  {", ".join(_past(u, n) for u, n in _INSURED)} FROM daily GROUP BY ALL)
SELECT * FROM now WHERE amount IS NOT NULL""",
)
def plan_insurance_outstanding(t: Tables) -> DataFrame:
    contracts = t.supplier.select(
        F.col("s_suppkey").alias("contract"), F.col("s_nationkey").alias("account"),
        F.when(F.col("s_acctbal") > 5000, "R").otherwise("A").alias("product"),
        F.when(F.col("s_acctbal") > 0, "VALID").otherwise("ENDED").alias("state"),
        F.col("s_acctbal").alias("since"),
    )
    reports = t.lineitem.select(
        F.col("l_suppkey").alias("contract"), F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_extendedprice").alias("amount"), "l_linestatus", F.col("l_returnflag").alias("product"),
    )
    first = reports.where("l_linestatus = 'O'").select(F.lit("first").alias("insurer"), "contract", "day", "amount")
    second = reports.where("l_linestatus <> 'O'").select(
        F.lit("second").alias("insurer"), "contract", "day", "amount", "product"
    )
    return h.insurance_outstanding([first, second], contracts, REF, ["VALID"])


# --- accounts ------------------------------------------------------------------------------------

CURRENCIES = [
    ("1-URGENT", "504", "2099-12-31"), ("2-HIGH", "978", "2099-12-31"), ("3-MEDIUM", "840", "2099-12-31"),
    ("4-NOT SPECIFIED", "826", "1999-01-01"),
]


def _crc(text: str) -> str:
    """crc32 of a text that is not null."""
    data = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    return f"xor(list_reduce([CAST(4294967295 AS BIGINT)] || {data}, lambda crc, byte: {_CRC_STEP}), 4294967295)"


@query(
    "plan_account_dimension",
    f"""WITH cur(currency, code, dfval) AS ({values_sql(CURRENCIES)}),
latest AS (SELECT o_custkey AS account, o_orderstatus AS portfolio, o_orderpriority AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus, o_orderpriority) AS rn
  FROM orders) AS x WHERE rn = 1),
disputed AS (SELECT account, {_crc("portfolio || '/' || place")} AS dispute_key FROM latest),
owned AS (SELECT s_suppkey AS customer, {_crc("CAST(s_nationkey AS VARCHAR) || '/' || s_name")} AS customer_key FROM supplier),
accounts AS (SELECT c_custkey AS account, CASE WHEN c_acctbal > 5000 THEN '1-URGENT' WHEN c_acctbal > 2000 THEN '2-HIGH' ELSE '4-NOT SPECIFIED' END AS currency,
  CAST(c_nationkey AS BIGINT) AS element FROM customer),
holders AS (SELECT CAST(s_nationkey AS BIGINT) AS element, MIN(s_suppkey) AS customer FROM supplier GROUP BY 1),
known AS (
  SELECT accounts.account, cur.code, customer, element, dispute_key, COALESCE(dispute_key, customer_key) AS portfolio_key, 'origin' AS kind
  FROM accounts LEFT JOIN disputed USING (account) LEFT JOIN holders USING (element) LEFT JOIN owned USING (customer)
  LEFT JOIN cur ON cur.currency = accounts.currency AND CAST(cur.dfval AS DATE) > {R}),
held AS (SELECT DISTINCT o_custkey AS account, CASE o_orderpriority WHEN '1-URGENT' THEN '504' WHEN '2-HIGH' THEN '978' ELSE '000' END AS code FROM orders),
everything AS (SELECT * FROM known UNION ALL
  SELECT account, code, NULL, NULL, NULL, NULL, '-1' FROM held
  WHERE NOT EXISTS (SELECT 1 FROM known WHERE known.account = held.account AND known.code = held.code))
SELECT account, COALESCE(code, '-1') AS code, COALESCE(customer, -1) AS customer, COALESCE(element, -1) AS element,
  COALESCE(dispute_key, -1) AS dispute_key, COALESCE(portfolio_key, -1) AS portfolio_key, kind, account || COALESCE(code, '0') AS account_key
FROM everything""",
)
def plan_account_dimension(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    currency = F.when(balance > 5000, "1-URGENT").when(balance > 2000, "2-HIGH").otherwise("4-NOT SPECIFIED")
    accounts = t.customer.select(
        F.col("c_custkey").alias("account"), currency.alias("currency"),
        F.col("c_nationkey").cast("bigint").alias("element"),
    )
    holders = t.supplier.groupBy(F.col("s_nationkey").cast("bigint").alias("element")).agg(
        F.min("s_suppkey").alias("customer")
    )
    disputes = t.orders.select(
        F.col("o_custkey").alias("account"), F.col("o_orderstatus").alias("portfolio"),
        F.col("o_orderpriority").alias("place"), F.col("o_orderdate").alias("modified"),
    )
    portfolios = t.supplier.select(
        F.col("s_suppkey").alias("customer"), F.col("s_nationkey").cast("string").alias("portfolio"),
        F.col("s_name").alias("place"),
    )
    codes = literal_rows(t.spark, "currency string, code string, dfval string", CURRENCIES)
    code = F.when(F.col("o_orderpriority") == "1-URGENT", "504").when(F.col("o_orderpriority") == "2-HIGH", "978")
    held = t.orders.select(F.col("o_custkey").alias("account"), code.otherwise("000").alias("code"))
    return a.account_dimension(accounts, holders, disputes, portfolios, codes, held, REF)


@query(
    "plan_digital_usage",
    """WITH held AS (
  SELECT DISTINCT user_id AS customer, event_type AS product, substr(props, 7, 1) AS option FROM events WHERE event_type IN ('signup', 'purchase')),
related AS (SELECT DISTINCT user_id AS customer FROM events WHERE event_type = 'error' AND value > 200),
access AS (
  SELECT DISTINCT COALESCE(held.customer, related.customer) AS customer, option,
    CASE WHEN option IN ('1', '3') THEN 'consultation' WHEN option IN ('4', '5', '6') THEN 'transaction' END AS access
  FROM held FULL OUTER JOIN related ON related.customer = held.customer
  WHERE option IN ('1', '3', '4', '5', '6') OR (product = 'purchase') OR related.customer IS NOT NULL),
counts AS (
  SELECT user_id, ts, CAST(ts AS DATE) AS day, DATE '2024-01-30' AS snapshot FROM events WHERE event_type = 'view'),
used AS (
  SELECT user_id AS customer, strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS last_event, COUNT(DISTINCT CASE WHEN day = snapshot THEN ts END) AS events_day,
    COUNT(DISTINCT CASE WHEN date_trunc('week', day) = date_trunc('week', snapshot) THEN ts END) AS events_week,
    COUNT(DISTINCT CASE WHEN date_trunc('month', day) = date_trunc('month', snapshot) THEN ts END) AS events_month
  FROM counts GROUP BY 1)
SELECT c_custkey AS customer, option, access, CASE WHEN used.customer IS NULL THEN NULL ELSE '2024-01-30' END AS snapshot, last_event,
  COALESCE(events_day, 0) AS events_day, COALESCE(events_week, 0) AS events_week, COALESCE(events_month, 0) AS events_month,
  CASE WHEN access.customer IS NULL THEN 0 ELSE 1 END AS is_digital
FROM customer LEFT JOIN access ON access.customer = c_custkey LEFT JOIN used ON used.customer = c_custkey""",
)
def plan_digital_usage(t: Tables) -> DataFrame:
    """The first digit of the properties is the access option; users are customers."""
    contracts = t.events.select(
        F.col("user_id").alias("customer"), F.col("event_type").alias("product"), F.col("props").alias("details")
    )
    related = t.events.where("event_type = 'error' AND value > 200").select(
        F.col("user_id").alias("customer"), F.lit(True).alias("related")
    )
    views = t.events.where("event_type = 'view'").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user"), "ts",
        F.lit("2024-01-30").cast("date").alias("snapshot"),
    )
    customers = t.customer.select(F.col("c_custkey").alias("customer"))
    users = customers.select("customer", F.concat(F.lit("u"), F.col("customer").cast("string")).alias("user"))
    usage = a.digital_usage(
        customers, contracts, related, users, views, 7,
        {"consultation": ["1", "3"], "transaction": ["4", "5", "6"]}, ["signup"], always=["purchase"],
    )
    return usage.withColumn("last_event", F.date_format("last_event", "yyyy-MM-dd HH:mm:ss"))


# --- loans, segments, contracts ---------------------------------------------------------


@query(
    "plan_loan_commitments",
    """WITH steps AS (
  SELECT l_orderkey AS file, l_linenumber AS step, CAST(l_extendedprice AS DECIMAL(18,2)) AS disbursed FROM lineitem),
current AS (SELECT * FROM (SELECT *, max(step) OVER (PARTITION BY file) AS newest FROM steps) AS s WHERE step = newest),
figures AS (SELECT l_orderkey AS file, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS total, COUNT(*) AS n FROM lineitem GROUP BY 1),
files AS (SELECT o_orderkey AS file, o_custkey AS account, CASE WHEN n = 1 THEN total ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS nominal
  FROM orders JOIN figures ON file = o_orderkey)
SELECT files.file, account, CAST(nominal AS DOUBLE) AS nominal, step, CAST(disbursed AS DOUBLE) AS disbursed,
  CAST(total AS DOUBLE) AS total, o_orderstatus AS status,
  CASE WHEN disbursed <> nominal THEN 'PARTIAL' ELSE 'TOTAL' END AS disbursement
FROM files JOIN current USING (file) JOIN figures USING (file) JOIN orders ON o_orderkey = files.file""",
)
def plan_loan_commitments(t: Tables) -> DataFrame:
    """Orders as loan files, their lines as the steps of the schedule."""
    steps = t.lineitem.select(
        F.col("l_orderkey").alias("file"), F.col("l_linenumber").alias("step"), cents("l_extendedprice").alias("disbursed")
    )
    figures = steps.groupBy("file").agg(F.sum("disbursed").alias("total"), F.count("*").alias("n"))
    launched = t.orders.select(
        F.col("o_orderkey").alias("file"), F.col("o_custkey").alias("account"), cents("o_totalprice").alias("price")
    )
    nominal = F.when(F.col("n") == 1, F.col("total")).otherwise(F.col("price")).alias("nominal")
    files = launched.join(figures, "file").select("file", "account", nominal)
    states = t.orders.select(F.col("o_orderkey").alias("file"), F.col("o_orderstatus").alias("status"))
    parts = [(figures, {"total": "total"}), (states, {"status": "status"})]
    return loan_commitments(files, steps, parts, ("PARTIAL", "TOTAL"))


@query(
    "plan_segment_dimension",
    f"""WITH segments AS (SELECT c_mktsegment AS segment, lower(c_mktsegment) AS label FROM customer GROUP BY 1
  HAVING CAST(DATE '1998-01-01' + INTERVAL (COUNT(*)) DAY AS DATE) > DATE '{SEGMENT_DATE}'),
subs AS (SELECT CAST(n_nationkey AS VARCHAR) AS sub_segment, n_name AS sub_label FROM nation
  WHERE DATE '1998-01-01' + INTERVAL (n_nationkey) DAY > DATE '{SEGMENT_DATE}'),
used AS (SELECT DISTINCT c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS sub_segment, r_name AS product_line
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)
SELECT segment, sub_segment, product_line, label, sub_label FROM used JOIN segments USING (segment) JOIN subs USING (sub_segment)
WHERE product_line <> 'AFRICA'
UNION ALL SELECT '-1', '-1', '-1', '-1', '-1'""",
)
def plan_segment_dimension(t: Tables) -> DataFrame:
    """Market segments of the customers, by nation."""
    start = F.lit("1998-01-01").cast("date")
    segments = t.customer.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.lower(F.first("c_mktsegment")).alias("label"), F.date_add(start, F.count("*").cast("int")).alias("dfval")
    )
    subs = t.nation.select(
        F.col("n_nationkey").cast("string").alias("sub_segment"), F.col("n_name").alias("sub_label"),
        F.date_add(start, F.col("n_nationkey").cast("int")).alias("dfval"),
    )
    regions = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    members = t.customer.join(regions, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("sub_segment"),
        F.col("r_name").alias("product_line"),
    )
    return segment_dimension(members, segments, subs, SEGMENT_DATE, ["AFRICA"]).drop("segment_key")


@query(
    "plan_contract_graph",
    """WITH edges AS (
  SELECT DISTINCT l_orderkey AS account, l_partkey AS element FROM lineitem
  UNION SELECT a.l_orderkey, l.ps FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) AS a
    JOIN (SELECT DISTINCT l_partkey AS p, l_suppkey AS ps FROM lineitem) AS l ON l.p = a.l_partkey),
contracts AS (SELECT p_size AS contract, arg_max(p_type, p_partkey) AS contract_type FROM part GROUP BY 1)
SELECT account, element, contract, p_brand AS product, contract_type, holder
FROM edges JOIN part ON p_partkey = element JOIN contracts ON contract = p_size
LEFT JOIN (SELECT c_nationkey, MIN(c_custkey) AS holder FROM customer GROUP BY 1) AS h ON c_nationkey = contract
WHERE p_brand IN (SELECT p_brand FROM part GROUP BY 1 HAVING COUNT(*) % 2 = 0)
  AND contract_type IN (SELECT p_type FROM part GROUP BY 1 HAVING COUNT(*) % 2 = 0)""",
)
def plan_contract_graph(t: Tables) -> DataFrame:
    """Orders as accounts, parts as elements, part sizes as contracts, customers as holders."""
    accounts = t.lineitem.select(F.col("l_orderkey").alias("account"), F.col("l_partkey").alias("element")).distinct()
    links = t.lineitem.select(F.col("l_partkey").alias("element"), F.col("l_suppkey").alias("linked")).distinct()
    elements = t.part.select(
        F.col("p_partkey").alias("element"), F.col("p_size").alias("contract"), F.col("p_brand").alias("product")
    )
    contracts = t.part.groupBy(F.col("p_size").alias("contract")).agg(F.max_by("p_type", "p_partkey").alias("contract_type"))
    since, until = F.lit("2000-01-01").cast("date"), F.lit("2002-01-01").cast("date")
    kinds = t.part.groupBy(F.col("p_type").alias("contract_type")).agg(
        F.when(F.count("*") % 2 == 0, until).otherwise(since).alias("dfval")
    )
    products = t.part.groupBy(F.col("p_brand").alias("product")).agg(
        F.when(F.count("*") % 2 == 0, until).otherwise(since).alias("dfval")
    )
    holders = t.customer.groupBy(F.col("c_nationkey").alias("contract")).agg(F.min("c_custkey").alias("holder"))
    return contract_graph(
        accounts, links, elements, contracts, holders.withColumn("main", F.lit(True)), kinds, products, REF
    )


# --- equipment ------------------------------------------------------------------------------

FAMILIES = {"cards": ["Brand#11", "Brand#12", "Brand#13"], "packages": ["Brand#21", "Brand#22"], "insurance": ["Brand#31", "Brand#32", "Brand#33"]}
_FAMILY = "CASE " + " ".join(f"WHEN p_brand IN ({', '.join(repr(b) for b in of)}) THEN '{name}'" for name, of in FAMILIES.items()) + " END"


def _recent(last: str) -> str:
    return f"CASE WHEN {last} BETWEEN day - 90 AND day THEN 1 ELSE 0 END"


def _sold(unit: str) -> str:
    return f"CASE WHEN state = 'N' AND date_trunc('{unit}', since) = date_trunc('{unit}', day) THEN 1 ELSE 0 END AS is_{unit}ly"


@query(
    "plan_customer_equipment",
    f"""WITH history AS (
  SELECT l_partkey AS contract, CAST(l_shipdate AS DATE) AS day, arg_max(l_returnflag, l_orderkey * 10 + l_linenumber) AS state,
    min(l_suppkey) AS holder FROM lineitem GROUP BY 1, 2),
lagged AS (SELECT *, lag(day) OVER w AS p_day, lag(state) OVER w AS p_state FROM history WINDOW w AS (PARTITION BY contract ORDER BY day)),
seen AS (SELECT *, {", ".join(
        f"last_value(CASE WHEN date_trunc('{u}', day) <> date_trunc('{u}', p_day) THEN p_state END IGNORE NULLS) OVER run AS prev_{u}_state"
        for u in ("week", "month", "year"))}
  FROM lagged WINDOW run AS (PARTITION BY contract ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
held AS (SELECT s.*, p_brand AS product, {_FAMILY} AS family, CAST(day - CAST(p_size AS INTEGER) AS DATE) AS since FROM seen s JOIN part ON p_partkey = contract),
used AS (SELECT o_custkey AS contract, max(CAST(o_orderdate AS DATE)) AS last_card_use FROM orders GROUP BY 1),
met AS (SELECT o_custkey AS holder, max(CAST(o_orderdate AS DATE)) AS last_connection FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT contract, holder, product, family, state, CAST(since AS VARCHAR) AS since, CAST(day AS VARCHAR) AS day, s_name AS holder_name,
  CAST(s_nationkey AS INTEGER) AS branch, n_name AS branch_name, prev_week_state, prev_month_state, prev_year_state,
  CAST(last_card_use AS VARCHAR) AS last_card_use, CAST(last_connection AS VARCHAR) AS last_connection,
  CASE WHEN state = 'N' THEN 1 ELSE 0 END AS is_valid, {_recent("last_card_use")} AS card_active, {_recent("last_connection")} AS digital_active,
  {_sold("week")}, {_sold("month")}, {_sold("year")}
FROM held LEFT JOIN supplier ON s_suppkey = holder LEFT JOIN nation ON n_nationkey = s_nationkey
LEFT JOIN used USING (contract) LEFT JOIN met USING (holder) WHERE family IS NOT NULL""",
)
def plan_customer_equipment(t: Tables) -> DataFrame:
    """Parts as contracts of their suppliers, a state a day; orders as uses."""
    place = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    history = t.lineitem.groupBy(F.col("l_partkey").alias("contract"), F.col("l_shipdate").cast("date").alias("day")).agg(
        F.max_by("l_returnflag", place).alias("state"), F.min("l_suppkey").alias("holder")
    )
    parts = t.part.select(F.col("p_partkey").alias("contract"), F.col("p_brand").alias("product"), "p_size")
    contracts = history.join(parts, "contract").select(
        "contract", "holder", "product", "state", F.date_sub("day", F.col("p_size").cast("int")).alias("since"), "day"
    )
    uses = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderpriority")
    return customer_equipment(
        contracts, history,
        t.supplier.select(F.col("s_suppkey").alias("holder"), F.col("s_name").alias("holder_name"), F.col("s_nationkey").alias("branch")),
        t.nation.select(F.col("n_nationkey").alias("branch"), F.col("n_name").alias("branch_name")),
        uses.select(F.col("o_custkey").alias("contract"), "day"),
        uses.where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("holder"), "day"),
        FAMILIES, valid="N",
    )
