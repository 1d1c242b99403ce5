"""Newest rows per group, extremes, validity and group totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from querybook.base import REF, Tables, cents, query
from tidemark.operators import joins as j
from tidemark.operators import latest as w


@query(
    "latest_row_per_key",
    """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders) AS t WHERE rn = 1""",
)
def latest_row_per_key(t: Tables) -> DataFrame:
    newest = w.latest_by(t.orders, "o_custkey", "o_orderdate", ties=["o_orderkey"])
    return newest.select(
        "o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus"
    )


@query(
    "latest_oldest_row_per_key",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity) AS rn
      FROM lineitem) AS t WHERE rn = 1""",
)
def latest_oldest_row_per_key(t: Tables) -> DataFrame:
    ties = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    oldest = w.latest_by(t.lineitem, "l_suppkey", "l_shipdate", ascending=True, ties=ties)
    return oldest.select("l_suppkey", *ties)


@query(
    "latest_attribute",
    """SELECT o_custkey, o_orderpriority
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderpriority DESC) AS rn FROM orders) AS t WHERE rn = 1""",
)
def latest_attribute(t: Tables) -> DataFrame:
    return w.latest_attribute(t.orders, "o_custkey", "o_orderpriority", "o_orderdate")


@query(
    "latest_group_max",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey, o_orderstatus) AS best FROM orders) AS t
WHERE o_totalprice = best""",
)
def latest_group_max(t: Tables) -> DataFrame:
    best = j.keep_group_extremes(t.orders, ["o_custkey", "o_orderstatus"], "o_totalprice")
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "latest_group_min_two_columns",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
  SELECT *, min(l_quantity) OVER (PARTITION BY l_orderkey) AS q,
         min(l_linenumber) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) AS t
WHERE l_quantity = q AND l_linenumber = n""",
)
def latest_group_min_two_columns(t: Tables) -> DataFrame:
    least = j.keep_group_extremes(
        t.lineitem, "l_orderkey", ["l_quantity", "l_linenumber"], largest=False
    )
    return least.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    "latest_per_week_of_month",
    """WITH marked AS (
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
         CAST(ceil((day(o_orderdate) + dayofweek(o_orderdate) + 1 - 1) / 7.0) AS INT) AS week
  FROM orders)
SELECT o_custkey, o_orderkey, CAST(day AS VARCHAR) AS day FROM (
  SELECT *, rank() OVER (PARTITION BY o_custkey, year(day), month(day), week ORDER BY day DESC) AS r
  FROM marked) AS t WHERE r = 1""",
)
def latest_per_week_of_month(t: Tables) -> DataFrame:
    newest = w.last_per_week_of_month(t.orders, "o_orderdate", "o_custkey")
    return newest.select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("day"))


@query(
    "valid_rows",
    f"""SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem
WHERE CAST(l_shipdate AS DATE) > DATE '{REF}'""",
)
def valid_rows(t: Tables) -> DataFrame:
    """Line items still open (not shipped) on the reference date."""
    valid = w.valid_at(t.lineitem, REF, end="l_shipdate")
    return valid.select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "valid_rows_at_row_date",
    """SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE)""",
)
def valid_rows_at_row_date(t: Tables) -> DataFrame:
    """Validity against the row's own snapshot date."""
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    at = F.col("o_orderdate").cast("date")
    valid = w.valid_at(joined, at, end="l_shipdate", inclusive=True)
    return valid.select("l_orderkey", "l_linenumber", "l_suppkey")


@query(
    "total_by_group",
    """WITH totals AS (
  SELECT c_nationkey, count(DISTINCT c_custkey) AS customers,
         count(DISTINCT CASE WHEN c_acctbal > 0 THEN c_custkey END) AS in_credit,
         CAST(sum(CASE WHEN c_acctbal < 0 THEN CAST(c_acctbal AS DECIMAL(18,2)) END) AS DOUBLE) AS overdrawn,
         min(c_acctbal) AS lowest, max(c_acctbal) AS highest
  FROM customer GROUP BY 1)
SELECT c_custkey, c_mktsegment, totals.* FROM customer JOIN totals USING (c_nationkey)""",
)
def total_by_group(t: Tables) -> DataFrame:
    balance, customer = F.col("c_acctbal"), F.col("c_custkey")
    out = j.with_group_totals(
        t.customer,
        "c_nationkey",
        {
            "customers": F.count_distinct(customer),
            "in_credit": F.count_distinct(F.when(balance > 0, customer)),
            "overdrawn": F.sum(F.when(balance < 0, cents("c_acctbal"))),
            "lowest": F.min(balance),
            "highest": F.max(balance),
        },
    )
    return out.drop("c_name", "c_acctbal")


@query(
    "total_by_group_sums",
    """WITH totals AS (
  SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS DOUBLE) AS returned,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_quantity, totals.* FROM lineitem JOIN totals USING (l_suppkey)""",
)
def total_by_group_sums(t: Tables) -> DataFrame:
    price = cents("l_extendedprice")
    out = j.with_group_totals(
        t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey",
                          "l_returnflag", "l_extendedprice"),
        "l_suppkey",
        {"returned": F.sum(F.when(F.col("l_returnflag") == "R", price)), "total": F.sum(price)},
    )
    return out.drop("l_returnflag", "l_extendedprice")
