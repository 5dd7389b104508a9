"""Key lookups, entity resolution and matching over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as O
from ..specs import Lookup
from .base import query, source

# Orders whose customer reference is missing, out of range, or good.
source(
    "loose_orders",
    """
    SELECT o_orderkey, o_totalprice, o_orderpriority,
      CASE WHEN o_orderpriority = '5-LOW' THEN CAST(NULL AS BIGINT)
           WHEN o_orderstatus = 'P' THEN o_custkey + 100000000 ELSE o_custkey END AS cust_ref,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 77 ELSE CAST(o_custkey % 25 AS INT) END AS nation_ref
    FROM {orders}
    """,
)


def _customers(d, value="c_name"):
    return O.key_map(d("customer"), "c_custkey", value, unique=True)


@query("fk_lookup", "SELECT o_orderkey, cust_ref, c_name AS customer FROM {loose_orders} LEFT JOIN customer ON cust_ref = c_custkey")
def _(d):
    return O.lookup_key(d("loose_orders"), _customers(d), "cust_ref", "customer").select("o_orderkey", "cust_ref", "customer")


@query(
    "fk_required_rejects",
    """SELECT o_orderkey, c_name AS customer, n_name AS nation,
         CASE WHEN c_name IS NULL THEN 'no customer' WHEN n_name IS NULL THEN 'no nation' END AS reason
       FROM {loose_orders} LEFT JOIN customer ON cust_ref = c_custkey LEFT JOIN nation ON nation_ref = n_nationkey""",
)
def _(d):
    nations = O.key_map(d("nation"), "n_nationkey", "n_name", unique=True)
    rows = O.lookup_required(
        d("loose_orders"),
        [
            Lookup("cust_ref", _customers(d), "customer", required=True, reason="no customer"),
            Lookup("nation_ref", nations, "nation", required=True, reason="no nation"),
        ],
    )
    return rows.select("o_orderkey", "customer", "nation", F.col(O.REJECT).alias("reason"))


@query(
    "role_playing_lookup",
    """SELECT l_orderkey, l_partkey, l_suppkey, a.s_name AS observer, b.s_name AS trainer FROM lineitem
         LEFT JOIN supplier a ON l_suppkey = a.s_suppkey LEFT JOIN supplier b ON l_partkey = b.s_suppkey""",
)
def _(d):
    m = O.key_map(d("supplier"), "s_suppkey", "s_name", unique=True)
    rows = O.lookup_key(O.lookup_key(d("lineitem"), m, "l_suppkey", "observer"), m, "l_partkey", "trainer")
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "observer", "trainer")


@query("lookup_default", "SELECT o_orderkey, coalesce(c_name, '') AS customer FROM {loose_orders} LEFT JOIN customer ON cust_ref = c_custkey")
def _(d):
    return O.lookup_key(d("loose_orders"), _customers(d), "cust_ref", "customer", F.lit("")).select("o_orderkey", "customer")


@query(
    "key_map_first_last",
    """SELECT o_custkey AS _key, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders GROUP BY 1""",
)
def _(d):
    first = O.key_map(d("orders"), "o_custkey", "o_orderkey").withColumnRenamed("_value", "first_id")
    last = O.key_map(d("orders"), "o_custkey", "o_orderkey", keep="last").withColumnRenamed("_value", "last_id")
    return first.join(last, "_key")


@query(
    "chained_lookup_reasons",
    """SELECT o_orderkey, c_nationkey AS hop1, r_name AS hop2,
         CASE WHEN c_nationkey IS NULL THEN 'missing_old' WHEN r_name IS NULL THEN 'missing_new' END AS reason
       FROM {loose_orders} LEFT JOIN customer ON cust_ref = c_custkey LEFT JOIN region ON c_nationkey = r_regionkey""",
)
def _(d):
    hop1 = O.key_map(d("customer"), "c_custkey", "c_nationkey", unique=True)
    hop2 = O.key_map(d("region"), "r_regionkey", "r_name", unique=True)
    rows = O.lookup_chain(
        d("loose_orders"),
        [
            Lookup("cust_ref", hop1, "hop1", required=True, reason="missing_old"),
            Lookup("hop1", hop2, "hop2", required=True, reason="missing_new"),
        ],
    )
    return rows.select("o_orderkey", "hop1", "hop2", F.col(O.REJECT).alias("reason"))


# Known entities, each findable by some of its keys, and legacy records that carry such keys.
source(
    "entities",
    """
    SELECT 1000000 + c_custkey AS id,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 'S' || CAST(c_custkey AS STRING) END AS sf_id,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'M' || CAST(c_custkey AS STRING) || '@X.org' END AS email,
      CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN 'u' || CAST(c_custkey AS STRING) END AS username
    FROM {customer}
    """,
)
source(
    "legacy",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1000000 + o_custkey ELSE 5000000 + o_orderkey END AS legacy_id,
      CASE WHEN o_orderpriority = '1-URGENT' THEN 'S' || CAST(o_custkey AS STRING) END AS sf_id,
      CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'm' || CAST(o_custkey AS STRING) || '@x.org' END AS email,
      CASE WHEN o_orderpriority <> '5-LOW' THEN 'u' || CAST(o_custkey + 50 AS STRING) END AS username
    FROM {orders}
    """,
)


def _candidates(d):
    e = d("entities")
    return [
        ("legacy_id", O.key_map(e, "id", "id", unique=True)),
        ("sf_id", O.key_map(e, "sf_id", "id")),
        ("email", O.key_map(e, "email", "id", clean=True, lower=True)),
        ("username", O.key_map(e, "username", "id", clean=True, lower=True)),
    ]


RESOLVE = """FROM {{legacy}} l LEFT JOIN {{entities}} a ON l.legacy_id = a.id LEFT JOIN {{entities}} b ON l.sf_id = b.sf_id
    LEFT JOIN {{entities}} c ON l.email = lower(c.email) LEFT JOIN {{entities}} e ON l.username = e.username"""


@query("resolve_entity", f"SELECT o_orderkey, coalesce(a.id, b.id, c.id, e.id, l.legacy_id) AS actual_id {RESOLVE}".replace("{{", "{").replace("}}", "}"))
def _(d):
    rows = O.resolve_entity(d("legacy"), _candidates(d), "actual_id", F.col("legacy_id"))
    return rows.select("o_orderkey", "actual_id")


@query("resolve_entity_default", f"SELECT o_orderkey, coalesce(a.id, b.id, c.id, e.id, -1) AS actual_id {RESOLVE}".replace("{{", "{").replace("}}", "}"))
def _(d):
    rows = O.resolve_entity(d("legacy"), _candidates(d), "actual_id", F.lit(-1).cast("bigint"))
    return rows.select("o_orderkey", "actual_id")


# Records of one run that lead to each other: by account first, then by a shared amount class.
source(
    "run_records",
    """
    SELECT o_orderkey, o_orderdate,
      CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS account,
      CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(floor(o_totalprice / 40) AS BIGINT) END AS amount_class
    FROM {orders}
    """,
)


@query(
    "in_run_visibility",
    """WITH RECURSIVE f1 AS (SELECT account, min(o_orderkey) AS row1 FROM {run_records} WHERE account IS NOT NULL GROUP BY 1),
       f2 AS (SELECT amount_class, min(o_orderkey) AS row2 FROM {run_records} WHERE amount_class IS NOT NULL GROUP BY 1),
       p AS (SELECT r.o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN -1 - c.c_custkey END AS hit,
               CASE WHEN c.c_custkey IS NOT NULL THEN NULL WHEN row1 < r.o_orderkey THEN row1 WHEN row2 < r.o_orderkey THEN row2 END AS next
             FROM {run_records} r LEFT JOIN f1 ON r.account = f1.account LEFT JOIN f2 ON r.amount_class = f2.amount_class
             LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) c ON r.account = c.c_custkey),
       walk AS (SELECT o_orderkey, coalesce(hit, o_orderkey) AS entity, next FROM p
                UNION ALL SELECT w.o_orderkey, coalesce(p.hit, p.o_orderkey), p.next FROM walk w JOIN p ON w.next = p.o_orderkey)
       SELECT o_orderkey, entity FROM walk WHERE next IS NULL""",
)
def _(d):
    known = d("customer").filter(F.col("c_acctbal") < 0).select("c_custkey", (-1 - F.col("c_custkey")).alias("id"))
    none = known.limit(0).select("c_custkey", "id")
    rows = O.resolve_within(
        d("run_records"), "o_orderkey",
        [("account", O.key_map(known, "c_custkey", "id", unique=True)), ("amount_class", none)],
        ["o_orderkey"], "entity",
    )
    return rows.select("o_orderkey", "entity")


@query(
    "remap_cascade",
    """WITH c AS (SELECT c_custkey AS old_id, c_custkey * 10 AS actual_id FROM customer WHERE c_acctbal > 0),
       o AS (SELECT o_orderkey AS old_id, o_orderkey * 10 + 1 AS actual_id, actual_id AS cust FROM orders LEFT JOIN c ON o_custkey = old_id)
       SELECT l_orderkey, l_partkey, l_suppkey, o.actual_id AS order_id, CASE WHEN o.actual_id IS NULL THEN 'orphan:l_orderkey' END AS reason
       FROM lineitem LEFT JOIN (SELECT old_id, actual_id FROM o WHERE cust IS NOT NULL) o ON l_orderkey = o.old_id""".replace(
        "actual_id AS cust", "c.actual_id AS cust"
    ).replace("o_custkey = old_id", "o_custkey = c.old_id"),
)
def _(d):
    top = d("customer").filter(F.col("c_acctbal") > 0).select("c_custkey", (F.col("c_custkey") * 10).alias("id"))
    orders = O.remap_cascade(d("orders"), top, "o_custkey", "cust")
    kept, _orphans = O.split_rejects(orders)
    remap = kept.select("o_orderkey", (F.col("o_orderkey") * 10 + 1).alias("id"))
    lines = O.remap_cascade(d("lineitem"), remap, "l_orderkey", "order_id")
    return lines.select("l_orderkey", "l_partkey", "l_suppkey", "order_id", F.col(O.REJECT).alias("reason"))


source(
    "two_key_target",
    """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'S' || CAST(c_custkey AS STRING) END AS sf_id,
      'C' || CAST(c_custkey AS STRING) AS case_id FROM {customer}
    """,
)
source(
    "two_key_source",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN CAST(NULL AS STRING) ELSE 'S' || CAST(o_custkey AS STRING) END AS sf_id,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'C' || CAST(o_custkey + 1 AS STRING) WHEN '2-HIGH' THEN CAST(NULL AS STRING)
        WHEN '5-LOW' THEN 'none' ELSE 'C' || CAST(o_custkey AS STRING) END AS case_id
    FROM {orders}
    """,
)


@query(
    "or_key_match",
    """WITH m AS (SELECT s.o_orderkey, t.id FROM {two_key_source} s JOIN {two_key_target} t ON s.sf_id = t.sf_id
               UNION SELECT s.o_orderkey, t.id FROM {two_key_source} s JOIN {two_key_target} t ON s.case_id = t.case_id),
       n AS (SELECT o_orderkey, count(*) AS k, min(id) AS id FROM m GROUP BY 1)
       SELECT s.o_orderkey, coalesce(k, 0)::INT AS n_matches, CASE WHEN k = 1 THEN id END AS target_id
       FROM {two_key_source} s LEFT JOIN n ON s.o_orderkey = n.o_orderkey""",
)
def _(d):
    rows = O.match_any_key(d("two_key_source"), d("two_key_target"), ["sf_id", "case_id"])
    return rows.select("o_orderkey", "n_matches", "target_id")


@query(
    "composite_anti",
    """WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag ORDER BY l_orderkey, l_partkey) AS rn FROM lineitem)
       SELECT l_suppkey, l_linenumber, l_returnflag, l_orderkey FROM f WHERE rn = 1 AND NOT EXISTS
         (SELECT 1 FROM lineitem h WHERE h.l_quantity > 45 AND h.l_suppkey = f.l_suppkey AND h.l_linenumber = f.l_linenumber AND h.l_returnflag = f.l_returnflag)""",
)
def _(d):
    key = ["l_suppkey", "l_linenumber", "l_returnflag"]
    held = d("lineitem").filter(F.col("l_quantity") > 45).select(*key)
    rows = O.not_existing(d("lineitem"), held, key, ["l_orderkey", "l_partkey"])
    return rows.select(*key, "l_orderkey")


# Regions, nations and customers as one hierarchy; every third customer names an unknown parent.
source(
    "places",
    """
    SELECT 'r' || CAST(r_regionkey AS STRING) AS sf_id, CAST(NULL AS STRING) AS parent_ref, r_regionkey + 0 AS id, CAST(NULL AS BIGINT) AS parent_id FROM {region}
    UNION ALL
    SELECT 'n' || CAST(n_nationkey AS STRING), 'r' || CAST(n_regionkey AS STRING), 100 + n_nationkey, CAST(NULL AS BIGINT) FROM {nation}
    UNION ALL
    SELECT 'c' || CAST(c_custkey AS STRING), CASE WHEN c_acctbal < 0 THEN 'n?' ELSE 'n' || CAST(c_nationkey AS STRING) END, 1000 + c_custkey,
      CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(100 + c_nationkey AS BIGINT) ELSE CAST(7 AS BIGINT) END FROM {customer}
    """,
)


@query(
    "parent_link",
    """SELECT c.sf_id, coalesce(p.id, c.parent_id) AS parent_id, p.id IS NOT NULL AND c.parent_id IS DISTINCT FROM p.id AS link_changed,
         CASE WHEN p.id IS NOT NULL AND c.parent_id IS DISTINCT FROM p.id THEN TIMESTAMP '2024-06-01' ELSE TIMESTAMP '2024-01-01' END AS updated_at
       FROM {places} c LEFT JOIN {places} p ON c.parent_ref = p.sf_id""",
)
def _(d):
    rows = d("places").select("sf_id", "parent_ref", F.col("id").cast("bigint").alias("id"), "parent_id",
                              F.lit("2024-01-01").cast("timestamp_ntz").alias("updated_at"))
    out = O.link_parent(rows, "sf_id", "parent_ref", "id", "parent_id",
                        now=F.lit("2024-06-01").cast("timestamp_ntz"), stamp="updated_at")
    return out.select("sf_id", "parent_id", "link_changed", "updated_at")


CODES = {"1-URGENT": "Super Admin", "2-HIGH": "Project Manager", "3-MEDIUM": "Business Advisor"}


@query(
    "map_codes",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Super Admin' WHEN '2-HIGH' THEN 'Project Manager'
         WHEN '3-MEDIUM' THEN 'Business Advisor' END AS role,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Super Admin' WHEN '2-HIGH' THEN 'Project Manager'
         WHEN '3-MEDIUM' THEN 'Business Advisor' ELSE lower(o_orderpriority) END AS role_or_code FROM orders""",
)
def _(d):
    rows = O.map_codes(d("orders"), "o_orderpriority", CODES, "role")
    rows = O.map_codes(rows, "o_orderpriority", CODES, "role_or_code", F.lower("o_orderpriority"))
    return rows.select("o_orderkey", "role", "role_or_code")


@query(
    "unmapped_report",
    "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM')",
)
def _(d):
    rows = O.map_codes(d("orders"), "o_orderpriority", CODES, "role")
    return O.unmapped(rows, ["o_orderstatus", "o_orderpriority"], "role")


# Several orders share an id here, some have none: the first of an id counts, and all of them get its entity.
source(
    "repeated_records",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_orderkey / 5) AS BIGINT) END AS rid,
         CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS account FROM {orders}""",
)


@query(
    "in_run_visibility_repeated_ids",
    """WITH n AS (SELECT rid, o_orderkey AS k, account FROM {repeated_records} WHERE rid IS NOT NULL QUALIFY row_number() OVER (PARTITION BY rid ORDER BY o_orderkey) = 1),
       f AS (SELECT account, arg_min(rid, k) AS rid1, min(k) AS k1 FROM n WHERE account IS NOT NULL GROUP BY 1),
       e AS (SELECT n.rid, CASE WHEN k1 < k THEN rid1 ELSE n.rid END AS entity FROM n LEFT JOIN f ON n.account = f.account)
       SELECT o_orderkey, entity FROM {repeated_records} r LEFT JOIN e ON r.rid = e.rid""",
)
def _(d):
    none = d("customer").select("c_custkey", F.col("c_custkey").alias("id")).where("c_custkey IS NULL")
    rows = O.resolve_within(d("repeated_records"), "rid", [("account", none)], ["o_orderkey"], "entity")
    return rows.select("o_orderkey", "entity")
