"""Keys, enrichment, matching and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from querybook.base import Tables, cents, query
from tidemark.functions import keys
from tidemark.operators import shaping as s


@query(
    "shape_project_rename",
    """SELECT DISTINCT upper(trim(substr(p_brand, 7, 2))) AS brand_number, p_type AS kind, CAST(p_size AS BIGINT) AS size
FROM part WHERE p_retailprice > 950""",
)
def shape_project_rename(t: Tables) -> DataFrame:
    """Column names are matched without regard to case."""
    return (
        t.part.where("P_RETAILPRICE > 950")
        .select(
            F.upper(F.trim(F.substring("P_Brand", 7, 2))).alias("brand_number"),
            F.col("P_TYPE").alias("kind"),
            F.col("p_size").cast("bigint").alias("size"),
        )
        .distinct()
    )


@query(
    "shape_unknown_member",
    """SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL SELECT -1, '-1', -1""",
)
def shape_unknown_member(t: Tables) -> DataFrame:
    return s.with_unknown_member(t.nation)


@query(
    "shape_fill_unknown",
    """SELECT c_custkey, c_mktsegment, COALESCE(user_id, -1) AS user_id, COALESCE(last_type, '-1') AS last_type
FROM customer LEFT JOIN (SELECT user_id, MAX(event_type) AS last_type FROM events GROUP BY 1) AS u ON user_id = c_custkey""",
)
def shape_fill_unknown(t: Tables) -> DataFrame:
    """Customers and their events, which most customers do not have."""
    users = t.events.groupBy("user_id").agg(F.max("event_type").alias("last_type"))
    customers = t.customer.select("c_custkey", "c_mktsegment")
    return s.fill_unknown(customers.join(users, customers["c_custkey"] == users["user_id"], "left"))


@query(
    "key_md5",
    """SELECT c_custkey, CASE WHEN k <> '' THEN md5(k) END AS pk FROM (
  SELECT c_custkey, concat_ws('|#', NULLIF(trim(lower(c_name)), ''), NULLIF(CAST(c_nationkey AS VARCHAR), ''),
    NULLIF(trim(lower(CASE WHEN c_acctbal > 0 THEN ' ' || c_mktsegment || ' ' ELSE '  ' END)), '')) AS k FROM customer) AS t""",
)
def key_md5(t: Tables) -> DataFrame:
    padded = F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))
    part = F.when(F.col("c_acctbal") > 0, padded).otherwise("  ")
    rows = t.customer.withColumn("segment", part)
    return rows.select("c_custkey", keys.primary_key("c_name", "c_nationkey", "segment").alias("pk"))


_CRC_STEP = (
    "list_reduce([xor(crc, byte)] || [0, 0, 0, 0, 0, 0, 0, 0],"
    " lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))"
)


@query(
    "key_crc32",
    f"""WITH texts AS (SELECT c_custkey, concat_ws('/', c_custkey, c_mktsegment) AS text FROM customer),
bytes AS (SELECT c_custkey, list_transform(string_split(text, ''), lambda ch: CAST(ord(ch) AS BIGINT)) AS b FROM texts)
SELECT c_custkey, xor(list_reduce([CAST(4294967295 AS BIGINT)] || b, lambda crc, byte: {_CRC_STEP}), 4294967295) AS crc_key
FROM bytes""",
)
def key_crc32(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", keys.surrogate_key("c_custkey", "c_mktsegment").alias("crc_key")
    )


@query(
    "key_xxhash64",
    """SELECT c_mktsegment, COUNT(*) AS n_rows, COUNT(DISTINCT c_custkey) AS n_keys, 0::BIGINT AS n_nulls
FROM customer GROUP BY 1""",
)
def key_xxhash64(t: Tables) -> DataFrame:
    """64-bit keys per segment: as many as there are customers, none of them null."""
    wide = keys.surrogate_key("c_custkey", "c_mktsegment", wide=True)
    return t.customer.withColumn("wide_key", wide).groupBy("c_mktsegment").agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("wide_key").alias("n_keys"),
        F.count_if(F.col("wide_key").isNull()).alias("n_nulls"),
    )


# --- hierarchy: suppliers, nations and regions in one self-referring table -----------------

UNITS = """units AS (
  SELECT 'S' || s_suppkey AS code, s_name AS name, CASE WHEN s_acctbal > 3000 THEN 'N' || s_nationkey END AS group_ref,
    'N' || s_nationkey AS nation_ref, 'R' || n_regionkey AS region_ref FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION ALL SELECT 'N' || n_nationkey, n_name, NULL, 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'R' || r_regionkey, r_name, NULL, NULL, NULL FROM region)"""


def units(t: Tables) -> DataFrame:
    def code(letter: str, column: str):
        return F.concat(F.lit(letter), F.col(column).cast("string"))

    none = F.lit(None).cast("string")
    nation = code("N", "s_nationkey")
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        code("S", "s_suppkey").alias("code"), F.col("s_name").alias("name"),
        F.when(F.col("s_acctbal") > 3000, nation).alias("group_ref"),
        nation.alias("nation_ref"), code("R", "n_regionkey").alias("region_ref"),
    )
    nations = t.nation.select(
        code("N", "n_nationkey").alias("code"), F.col("n_name").alias("name"), none.alias("group_ref"),
        code("N", "n_nationkey").alias("nation_ref"), code("R", "n_regionkey").alias("region_ref"),
    )
    regions = t.region.select(
        code("R", "r_regionkey").alias("code"), F.col("r_name").alias("name"), none.alias("group_ref"),
        none.alias("nation_ref"), none.alias("region_ref"),
    )
    return suppliers.unionByName(nations).unionByName(regions)


@query(
    "hierarchy_flatten",
    f"""WITH {UNITS}
SELECT u.*, COALESCE(u.group_ref, u.code) AS group_code, COALESCE(g.name, u.name) AS group_name,
  n.code AS nation_code, n.name AS nation_name, r.code AS region_code, r.name AS region_name
FROM units AS u LEFT JOIN units AS g ON g.code = u.group_ref
JOIN units AS n ON n.code = u.nation_ref JOIN units AS r ON r.code = u.region_ref""",
)
def hierarchy_flatten(t: Tables) -> DataFrame:
    levels = {"group": "group_ref", "nation": "nation_ref", "region": "region_ref"}
    return s.flatten_hierarchy(units(t), "code", "name", levels, fallback=["group"])


@query(
    "hierarchy_leaves",
    f"""WITH {UNITS} SELECT u.code, u.name FROM units AS u
WHERE NOT EXISTS (SELECT 1 FROM units AS x WHERE x.group_ref = u.code)""",
)
def hierarchy_leaves(t: Tables) -> DataFrame:
    return s.leaf_units(units(t), "code", "group_ref").select("code", "name")


# --- JSON -------------------------------------------------------------------------------


@query(
    "json_fields",
    """SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS weight,
  CAST(json_extract_string(props, '$."not there"') AS VARCHAR) AS missing FROM events""",
)
def json_fields(t: Tables) -> DataFrame:
    """Field names may contain spaces."""
    schema = T.StructType(
        [T.StructField("k", T.LongType()), T.StructField("not there", T.StringType())]
    )
    rows = t.events.select("event_id", "event_type", "props")
    return s.parse_json(rows, "props", schema, {"k": "weight", "not there": "missing"})


# --- lookups -----------------------------------------------------------------------------


@query(
    "shape_priority_lookup",
    """WITH a AS (SELECT user_id AS k, lower(MAX(event_type)) AS market, 'range a' AS rng FROM events GROUP BY 1),
b AS (SELECT s_suppkey AS k, lower(s_name) AS market, CASE WHEN s_nationkey % 2 = 0 THEN 'tpe' ELSE 'range b' END AS rng FROM supplier),
c AS (SELECT c_mktsegment AS k, 'customers ' || COUNT(*) AS market, 'range c' AS rng FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY 1)
SELECT c_custkey, c_nationkey, c_mktsegment,
  upper(COALESCE(CASE WHEN a.k IS NOT NULL AND b.rng = 'tpe' THEN b.market END, a.market, b.market, c.market, 'retail')) AS market,
  upper(COALESCE(CASE WHEN a.k IS NOT NULL AND b.rng = 'tpe' THEN b.rng END, a.rng, b.rng, c.rng, 'none')) AS rng
FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_custkey LEFT JOIN c ON c.k = c_mktsegment""",
)
def shape_priority_lookup(t: Tables) -> DataFrame:
    """By the customer's events, else the supplier of its number, else its segment, with
    one override."""
    by_events = t.events.groupBy(F.col("user_id").alias("k")).agg(
        F.lower(F.max("event_type")).alias("market"), F.lit("range a").alias("rng")
    )
    by_supplier = t.supplier.select(
        F.col("s_suppkey").alias("k"), F.lower("s_name").alias("market"),
        F.when(F.col("s_nationkey") % 2 == 0, "tpe").otherwise("range b").alias("rng"),
    )
    by_segment = t.customer.groupBy(F.col("c_mktsegment").alias("k")).agg(
        F.concat(F.lit("customers "), F.count("*").cast("string")).alias("market"), F.lit("range c").alias("rng")
    )
    maps = {
        "events": (by_events, "c_custkey", "k"),
        "supplier": (by_supplier, "c_custkey", "k"),
        "segment": (by_segment, "c_mktsegment", "k"),
    }
    return s.priority_lookup(
        t.customer.select("c_custkey", "c_nationkey", "c_mktsegment"), maps,
        {"market": "retail", "rng": "none"},
        override=("supplier", lambda get: get("events", "market").isNotNull() & (get("supplier", "rng") == "tpe")),
    )


@query(
    "shape_fallback_enrichment",
    """WITH a AS (SELECT user_id AS k, event_id AS number, event_type AS label FROM events),
b AS (SELECT s_nationkey AS k, s_suppkey AS number, s_name AS label FROM supplier)
SELECT c_custkey, a.number, a.label, 1 AS matched_by FROM customer JOIN a ON a.k = c_custkey
UNION ALL
SELECT c_custkey, b.number, b.label, CASE WHEN b.k IS NOT NULL THEN 2 END
FROM customer LEFT JOIN b ON b.k = c_nationkey WHERE c_custkey NOT IN (SELECT k FROM a)""",
)
def shape_fallback_enrichment(t: Tables) -> DataFrame:
    """From the customer's events, else from the suppliers of its nation."""
    events = t.events.select(
        F.col("user_id").alias("k"), F.col("event_id").alias("number"), F.col("event_type").alias("label")
    )
    suppliers = t.supplier.select(
        F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("number"), F.col("s_name").alias("label")
    )
    enriched = s.enrich_with_fallback(
        t.customer.select("c_custkey", "c_nationkey"), events, suppliers,
        {"c_custkey": "k"}, {"c_nationkey": "k"}, ["number", "label"],
    )
    return enriched.drop("c_nationkey")


@query(
    "shape_unmatched",
    """SELECT c_custkey, c_nationkey FROM customer
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)
  AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)""",
)
def shape_unmatched(t: Tables) -> DataFrame:
    """Customers without events whose number is no supplier's."""
    return s.unmatched_rows(
        t.customer.select("c_custkey", "c_nationkey"),
        [(t.events, {"c_custkey": "user_id"}), (t.supplier, {"c_custkey": "s_suppkey"})],
    )


@query(
    "shape_full_outer_rules",
    """WITH a AS (SELECT s_suppkey AS k, CASE s_nationkey % 3 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' ELSE 'OTHER' END AS segment FROM supplier),
b AS (SELECT user_id AS k, bool_or(event_type = 'error') AS related FROM events GROUP BY 1)
SELECT COALESCE(a.k, b.k) AS k, segment, CAST(related AS INT) AS related FROM a FULL OUTER JOIN b ON a.k = b.k
WHERE segment = 'BUILDING' OR (related AND segment IS NULL) OR (related AND segment = 'MACHINERY')""",
)
def shape_full_outer_rules(t: Tables) -> DataFrame:
    """Suppliers by segment against users and whether they met an error."""
    third = F.col("s_nationkey") % 3
    contracts = t.supplier.select(
        F.col("s_suppkey").alias("k"),
        F.when(third == 0, "BUILDING").when(third == 1, "MACHINERY").otherwise("OTHER").alias("segment"),
    )
    relations = t.events.groupBy(F.col("user_id").alias("k")).agg(
        F.bool_or(F.col("event_type") == "error").alias("related")
    )
    segment, related = F.col("segment"), F.col("related")
    return s.full_outer_rules(
        contracts, relations, "k",
        segment == "BUILDING", related & segment.isNull(), related & (segment == "MACHINERY"),
    )


@query(
    "shape_star",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_mktsegment AS segment, n_name AS nation, r_name AS region,
  p_brand AS brand, CAST(l_extendedprice AS DOUBLE) AS price
FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey
LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
JOIN part ON p_partkey = l_partkey""",
)
def shape_star(t: Tables) -> DataFrame:
    """Line items with five dimensions; nation follows from customer, region from nation."""
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("price"))
    dims = [
        s.Dimension(t.orders, {"l_orderkey": "o_orderkey"}, {"custkey": "o_custkey"}, "inner"),
        s.Dimension(t.customer, {"custkey": "c_custkey"}, {"segment": "c_mktsegment", "nationkey": "c_nationkey"}),
        s.Dimension(t.nation, {"nationkey": "n_nationkey"}, {"nation": "n_name", "regionkey": "n_regionkey"}),
        s.Dimension(t.region, {"regionkey": "r_regionkey"}, {"region": "r_name"}),
        s.Dimension(t.part, {"l_partkey": "p_partkey"}, {"brand": "p_brand"}, "inner"),
    ]
    return s.star_enrich(fact, dims).drop("custkey", "nationkey", "regionkey")


@query(
    "shape_pivot",
    """SELECT user_id, """ + ", ".join(
        f"COUNT(CASE WHEN event_type = '{v}' THEN 1 END) AS {v}_count,"
        f" strftime(MAX(CASE WHEN event_type = '{v}' THEN ts END), '%Y-%m-%d %H:%M:%S') AS {v}_last"
        for v in ("click", "purchase", "view")
    ) + " FROM events GROUP BY user_id",
)
def shape_pivot(t: Tables) -> DataFrame:
    last = F.max(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    return s.pivot_counts(
        t.events, "user_id", "event_type", ["click", "purchase", "view"],
        {"count": F.count("event_id"), "last": last}, fill=["count"],
    )


@query(
    "shape_pivot_two_stage",
    """WITH items AS (SELECT o_custkey, l_partkey, l_returnflag, COUNT(DISTINCT l_suppkey) AS n
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2, 3)
SELECT o_custkey, """ + ", ".join(
        f"CAST(COALESCE(SUM(CASE WHEN l_returnflag = '{v}' THEN n END), 0) AS BIGINT) AS {v}_suppliers" for v in "ANR"
    ) + " FROM items GROUP BY 1",
)
def shape_pivot_two_stage(t: Tables) -> DataFrame:
    """Distinct suppliers per part, then their sum per customer, by flag."""
    owners = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    per_item = t.lineitem.join(owners, "l_orderkey").groupBy("o_custkey", "l_partkey", "l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("n")
    )
    return s.pivot_counts(
        per_item, "o_custkey", "l_returnflag", ["A", "N", "R"], {"suppliers": F.sum("n")}, fill=["suppliers"]
    )


@query(
    "shape_routed_union",
    """SELECT 'customer' AS route, c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, s_acctbal FROM supplier WHERE s_acctbal < 5000
UNION ALL SELECT 'part', p_partkey, p_name, p_type, NULL FROM part WHERE p_size = 1""",
)
def shape_routed_union(t: Tables) -> DataFrame:
    customers = t.customer.where("c_acctbal < 0").select(
        F.lit("customer").alias("route"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = t.supplier.where("s_acctbal < 5000").select(
        F.lit("supplier").alias("route"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    parts = t.part.where("p_size = 1").select(
        F.lit("part").alias("route"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("segment"),
    )
    return s.routed_union([customers, suppliers, parts])


@query(
    "shape_route",
    """SELECT route, COUNT(*) AS n, CAST(SUM(price) AS DOUBLE) AS price FROM (
  SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'returned open' WHEN l_returnflag = 'R' THEN 'returned'
         WHEN l_discount > 0.05 THEN 'discounted' END AS route FROM lineitem) AS t
WHERE route IS NOT NULL GROUP BY 1""",
)
def shape_route(t: Tables) -> DataFrame:
    """Exclusive routes over one fact, which is read once."""
    returned = F.col("l_returnflag") == "R"
    routed = s.route(
        t.lineitem,
        {
            "returned open": returned & (F.col("l_linestatus") == "O"),
            "returned": returned,
            "discounted": F.col("l_discount") > 0.05,
        },
    )
    return routed.groupBy("route").agg(F.count("*").alias("n"), F.sum(cents("l_extendedprice")).alias("price"))
