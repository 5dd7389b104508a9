"""Merges of all order lines into all orders, and of customer records into customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as O
from ..specs import MergeSpec
from .base import query, source

source(
    "stored",
    """
    SELECT o_orderkey AS code, 'K' || CAST(o_orderkey AS STRING) AS alt, o_totalprice AS price, o_orderpriority AS note,
      o_orderdate AS created_at, o_orderdate AS updated_at, 'keeper' AS created_by FROM {orders}
    """,
)
# Several lines per order: one batch with repeated keys, new keys and null keys.
source(
    "batch",
    """
    SELECT CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_quantity > 45 THEN CAST(NULL AS BIGINT)
             WHEN l_returnflag = 'R' THEN l_orderkey + 1000000000 ELSE l_orderkey END AS code,
      CASE WHEN l_returnflag = 'R' THEN 'K+' ELSE 'K' END || CAST(l_orderkey AS STRING) AS alt,
      l_extendedprice AS price, CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS note,
      l_shipdate AS created_at, l_shipdate AS updated_at, 'loader' AS created_by, l_partkey, l_suppkey
    FROM {lineitem}
    """,
)
ORDER = ("updated_at", "l_partkey", "l_suppkey")
COLS = ["code", "alt", "price", "note", "created_at", "updated_at", "created_by"]


def _merge_sql(key, sets, where="true", first="created_by", keep_first=False):
    """Last row per key, least created_at, then a full join on the key."""
    return f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY {key}, CASE WHEN {key} IS NULL THEN l_partkey || '-' || l_suppkey || '-' || alt END
                 ORDER BY updated_at DESC, l_partkey DESC, l_suppkey DESC) AS rn,
               min(created_at) OVER (PARTITION BY {key}, CASE WHEN {key} IS NULL THEN l_partkey || '-' || l_suppkey || '-' || alt END) AS low,
               arg_max(note, (updated_at, l_partkey, l_suppkey)) FILTER (WHERE note IS NOT NULL) OVER (PARTITION BY {key}, CASE WHEN {key} IS NULL
                 THEN l_partkey || '-' || l_suppkey || '-' || alt END) AS last_note,
               arg_min(created_at, (updated_at, l_partkey, l_suppkey)) OVER (PARTITION BY {key}, CASE WHEN {key} IS NULL
                 THEN l_partkey || '-' || l_suppkey || '-' || alt END) AS first_created
             FROM {{batch}}),
    s AS (SELECT * FROM r WHERE rn = 1)
    SELECT {sets} FROM {{stored}} t FULL JOIN s ON t.{key} = s.{key}"""


def _sets(**special):
    out = []
    for c in COLS:
        upd = special.get(c, f"s.{c}")
        if isinstance(upd, tuple):
            upd, ins = upd
        else:
            ins = f"s.{c}"
        cond = special.get("_when", "true")
        out.append(
            f"CASE WHEN s.alt IS NULL THEN t.{c} WHEN t.alt IS NULL THEN {ins} WHEN {cond} THEN {upd} ELSE t.{c} END AS {c}"
        )
    return ", ".join(out)


LEAST = ("least(t.created_at, s.low)", "s.low")


@query("merge_on_key", _merge_sql("code", _sets()))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER))


@query("merge_small_source", _merge_sql("code", _sets()))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER, delta=True))


@query("merge_on_alt_key", _merge_sql("alt", _sets(created_at=LEAST)))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("alt",), ORDER, {"created_at": "least"}))


@query("merge_created_least", _merge_sql("code", _sets(created_at=LEAST, created_by=("t.created_by", "s.created_by"))))
def _(d):
    rules = {"created_at": "least", "created_by": "target"}
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER, rules))


@query("merge_keep_created", _merge_sql("code", _sets(created_at=("t.created_at", "s.first_created"))))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER, {"created_at": "target"}))


@query("merge_if_changed", _merge_sql("code", _sets(_when="t.updated_at IS DISTINCT FROM s.updated_at")))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER, changed="updated_at"))


@query("merge_coalesce_source", _merge_sql("code", _sets(note=("coalesce(s.last_note, t.note)", "s.last_note"))))
def _(d):
    return O.merge(d("stored"), d("batch"), MergeSpec(("code",), ORDER, {"note": "coalesce_source"}))


@query(
    "merge_action_counts",
    """WITH s AS (SELECT alt, arg_max(updated_at, (updated_at, l_partkey, l_suppkey)) AS u FROM {batch} GROUP BY 1)
       SELECT CASE WHEN t.alt IS NULL THEN 'inserted' WHEN s.alt IS NULL THEN 'kept' WHEN t.updated_at IS DISTINCT FROM s.u THEN 'updated'
         ELSE 'unchanged' END AS action, count(*) AS n FROM {stored} t FULL JOIN s ON t.alt = s.alt GROUP BY 1""",
)
def _(d):
    rows = O.merge_with_actions(d("stored"), d("batch"), MergeSpec(("alt",), ORDER, changed="updated_at"))
    return rows.groupBy(F.col("_action").alias("action")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "insert_only",
    f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY alt ORDER BY updated_at, l_partkey, l_suppkey) AS rn FROM {{batch}})
       SELECT {", ".join(COLS)} FROM {{stored}} UNION ALL
       SELECT {", ".join(COLS)} FROM f WHERE rn = 1 AND alt NOT IN (SELECT alt FROM {{stored}})""",
)
def _(d):
    return O.insert_only(d("stored"), d("batch"), ["alt"], ORDER)


@query(
    "merge_last_in_batch",
    """SELECT alt, max(updated_at) AS updated_at, min(created_at) AS created_at, arg_max(price, (updated_at, l_partkey, l_suppkey)) AS price
       FROM {batch} GROUP BY 1""",
)
def _(d):
    keep = ["updated_at", "created_at", "price"]
    return O.collapse(d("batch"), ["alt"], ORDER, {"created_at": "least"}, keep)


source(
    "mail_target",
    "SELECT c_custkey AS id, lower(c_name) || '@x.test' AS email, c_name AS first_name, 'stored' AS created_by FROM {customer}",
)
source(
    "mail_source",
    """
    SELECT o_orderkey + 1000000 AS id, CASE WHEN o_orderstatus = 'P' THEN 'new' || CAST(o_custkey AS STRING) || '@x.test'
      ELSE 'customer#' || lpad(CAST(o_custkey AS STRING), 9, '0') || '@x.test' END AS email, o_orderpriority AS first_name, 'loader' AS created_by
    FROM {orders}
    """,
)


@query(
    "merge_on_email",
    """WITH s AS (SELECT email, arg_max(first_name, id) AS first_name, min(id) AS id FROM {mail_source} GROUP BY 1)
       SELECT coalesce(t.id, s.id) AS id, coalesce(t.email, s.email) AS email, coalesce(s.first_name, t.first_name) AS first_name,
         coalesce(t.created_by, 'loader') AS created_by FROM {mail_target} t FULL JOIN s ON t.email = s.email""",
)
def _(d):
    rows = d("mail_source").withColumn("seq", F.col("id"))
    spec = MergeSpec(("email",), ("seq",), {"id": "target", "created_by": "target"})
    return O.merge(d("mail_target"), rows, spec)


# Customers as stored members and as incoming records: same row by both keys, only by the case
# key, moved to a new case key, two different rows, or new (several per case key).
source(
    "members",
    """
    SELECT CAST(c_custkey AS STRING) AS id, CASE WHEN c_mktsegment <> 'BUILDING' THEN 'S' || CAST(c_custkey AS STRING) END AS sf_id,
      'C' || CAST(c_custkey AS STRING) AS case_id, c_name AS name, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM {customer}
    """,
)
source(
    "records",
    """
    SELECT 'x' || CAST(c_custkey AS STRING) AS id, c_custkey AS seq,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'X' ELSE 'S' END || CAST(c_custkey AS STRING) AS sf_id,
      CASE c_mktsegment WHEN 'FURNITURE' THEN 'N' || CAST(c_custkey % 400 AS STRING)
        WHEN 'HOUSEHOLD' THEN 'C' || CAST(c_custkey + 1 AS STRING)
        WHEN 'MACHINERY' THEN 'N' || CAST(c_custkey % 600 AS STRING)
        ELSE 'C' || CAST(c_custkey AS STRING) END AS case_id,
      upper(c_name) AS name, CASE WHEN c_acctbal > 0 THEN TIMESTAMP '2023-01-01 00:00:00' ELSE TIMESTAMP '2025-01-01 00:00:00' END AS created_at
    FROM {customer}
    """,
)
GUARD = """
    WITH a AS (SELECT r.*, t1.id AS id1, t2.id AS id2,
                 CASE WHEN t1.id <> t2.id THEN 0 WHEN t1.id IS NULL AND t2.id IS NULL THEN 3 WHEN t2.id IS NULL AND r.case_id IS NOT NULL THEN 2 ELSE 1 END AS step
               FROM {records} r LEFT JOIN {members} t1 ON r.sf_id = t1.sf_id LEFT JOIN {members} t2 ON r.case_id = t2.case_id),
    o AS (SELECT case_id, arg_min(coalesce(id1, id), (step, seq)) AS owner FROM a WHERE step >= 2 AND id2 IS NULL GROUP BY 1),
    b AS (SELECT a.*, coalesce(id1, id2) AS hit, step = 0 OR (step = 2 AND coalesce(owner <> id1, false)) AS refused,
            CASE WHEN step = 3 THEN owner ELSE coalesce(id1, id2) END AS dest
          FROM a LEFT JOIN o ON a.case_id = o.case_id)"""


def _guarded(d):
    """Both sides with zone-less timestamps, like the tables."""
    ntz = F.col("created_at").cast("timestamp_ntz")
    target = d("members").withColumn("created_at", ntz)
    records = d("records").withColumn("created_at", ntz)
    spec = MergeSpec(("sf_id",), ("seq",), {"created_at": "least"})
    return O.guarded_merge(target, records, ("sf_id", "case_id"), spec)


@query(
    "guarded_merge",
    GUARD
    + """, w AS (SELECT dest, arg_max(name, (step, seq)) AS name, arg_max(case_id, (step, seq)) AS case_id,
            arg_min(sf_id, (step, seq)) AS sf_id, min(created_at) AS created_at FROM b WHERE NOT refused GROUP BY 1)
       SELECT coalesce(t.id, w.dest) AS id, coalesce(t.sf_id, w.sf_id) AS sf_id, coalesce(w.case_id, t.case_id) AS case_id,
         coalesce(w.name, t.name) AS name, least(t.created_at, w.created_at) AS created_at
       FROM {members} t FULL JOIN w ON t.id = w.dest""",
)
def _(d):
    return _guarded(d)[0]


@query(
    "guarded_actions",
    GUARD
    + """ SELECT id AS source_id, sf_id, case_id, CASE WHEN NOT refused THEN dest END AS target_id,
         CASE WHEN refused THEN 'duplicate_conflict' WHEN step = 3 AND dest = id THEN 'inserted' ELSE 'updated' END AS action FROM b""",
)
def _(d):
    return _guarded(d)[1]


# A third of the lines has no key, and many of those are equal in every column: each is a row of its own.
source(
    "keyless_batch",
    """SELECT CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_orderkey AS INT) END AS code, CAST(l_quantity AS DOUBLE) AS price, l_returnflag AS note
       FROM {lineitem} UNION ALL SELECT CASE WHEN l_orderkey % 3 <> 0 THEN CAST(l_orderkey AS INT) END, CAST(l_quantity AS DOUBLE), l_returnflag
       FROM {lineitem} WHERE l_linenumber = 1""",
)
source("keyless_stored", "SELECT CAST(o_orderkey AS INT) AS code, o_totalprice AS price, o_orderstatus AS note FROM {orders} WHERE o_orderkey % 2 = 0")


@query(
    "merge_null_int_keys",
    """WITH s AS (SELECT * FROM {keyless_batch} WHERE code IS NOT NULL QUALIFY row_number() OVER (PARTITION BY code ORDER BY price DESC, note DESC) = 1)
       SELECT coalesce(s.code, t.code) AS code, CASE WHEN s.code IS NULL THEN t.price ELSE s.price END AS price,
         CASE WHEN s.code IS NULL THEN t.note ELSE s.note END AS note FROM {keyless_stored} t FULL JOIN s ON t.code = s.code
       UNION ALL SELECT code, price, note FROM {keyless_batch} WHERE code IS NULL""",
)
def _(d):
    return O.merge(d("keyless_stored"), d("keyless_batch"), MergeSpec(("code",), ("price", "note")))


@query(
    "insert_only_null_keys",
    """SELECT code, price, note FROM {keyless_stored} UNION ALL
       (SELECT code, price, note FROM {keyless_batch} WHERE code NOT IN (SELECT code FROM {keyless_stored})
        QUALIFY row_number() OVER (PARTITION BY code ORDER BY price, note) = 1)
       UNION ALL SELECT code, price, note FROM {keyless_batch} WHERE code IS NULL""",
)
def _(d):
    return O.insert_only(d("keyless_stored"), d("keyless_batch"), ("code",), ("price", "note"))
