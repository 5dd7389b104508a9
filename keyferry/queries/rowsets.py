"""Filters, projections, counts and dedupe over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as O
from ..sources import count_rows
from .base import query, source

source("flagged_orders", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus = 'P' AS is_deleted FROM {orders}")


@query("soft_delete_filter", "SELECT o_orderkey, o_custkey, o_totalprice FROM {flagged_orders} WHERE NOT is_deleted")
def _(d):
    return O.filter_active(d("flagged_orders"), "is_deleted").select("o_orderkey", "o_custkey", "o_totalprice")


@query("count_before_scan", "SELECT count(*) AS n_rows FROM {flagged_orders} WHERE NOT is_deleted")
def _(d):
    return count_rows(O.filter_active(d("flagged_orders"), "is_deleted"))


@query(
    "sorted_projection",
    "SELECT l_comment_flag, l_orderkey, l_partkey, l_quantity, l_returnflag, l_suppkey FROM (SELECT *, l_returnflag || l_linestatus AS l_comment_flag FROM lineitem)",
)
def _(d):
    rows = d("lineitem").withColumn("l_comment_flag", F.concat("l_returnflag", "l_linestatus"))
    return O.sorted_projection(rows, ["l_orderkey", "l_suppkey", "l_partkey"], ["l_quantity", "l_orderkey"],
                               ["l_returnflag", "l_comment_flag"])


@query(
    "parent_path_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 5, 9))",
)
def _(d):
    hop = O.Hop("o_custkey", d("customer"), "c_custkey")
    return O.filter_by_parent(d("orders"), [hop], F.col("c_nationkey").isin(1, 5, 9)).select("o_orderkey", "o_custkey")


@query(
    "three_hop_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
         JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey = 2""",
)
def _(d):
    hops = [
        O.Hop("l_orderkey", d("orders"), "o_orderkey"),
        O.Hop("o_custkey", d("customer"), "c_custkey"),
        O.Hop("c_nationkey", d("nation"), "n_nationkey"),
    ]
    rows = O.filter_by_parent(d("lineitem"), hops, F.col("n_regionkey") == 2)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


source(
    "partial_lines",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_tax,
      CASE WHEN l_returnflag = 'R' THEN ' ' WHEN l_returnflag = 'N' THEN CAST(NULL AS STRING) ELSE l_linestatus END AS status
    FROM {lineitem}
    """,
)


@query(
    "require_all_split",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN status IS NULL OR trim(status) = '' THEN 'missing:status' WHEN l_tax IS NULL THEN 'missing:l_tax' END AS reason,
         CASE WHEN l_discount = 0 THEN 'missing:l_discount' WHEN l_tax = 0 THEN 'missing:l_tax'
              WHEN status IS NULL THEN 'missing:status' END AS strict_reason
       FROM {partial_lines}""",
)
def _(d):
    lenient = O.require_all(d("partial_lines"), ["status", "l_tax"]).withColumnRenamed(O.REJECT, "reason")
    strict = O.require_all(lenient, ["l_discount", "l_tax", "status"], falsy=True)
    return strict.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "reason", F.col(O.REJECT).alias("strict_reason"))


@query(
    "scope_semi",
    "SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def _(d):
    keys = d("customer").filter(F.col("c_acctbal") > 0).select("c_custkey")
    return O.in_scope(d("events"), keys, "user_id").select("event_id", "user_id", "event_type")


@query(
    "skip_listed_labels",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 'skipped_role' END AS reason FROM orders""",
)
def _(d):
    marked = O.reject_if(d("orders"), F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), "skipped_role")
    return marked.select("o_orderkey", F.col(O.REJECT).alias("reason"))


@query("distinct_keys", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL")
def _(d):
    return O.distinct_keys(d("orders"), "o_custkey")


source("stamped_events", "SELECT event_id, user_id, event_type, value, date_trunc('hour', ts) AS stamp FROM {events}")


@query(
    "dedupe_latest",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY stamp DESC, event_id) AS rn
       FROM {stamped_events}) WHERE rn = 1""",
)
def _(d):
    rows = O.dedupe_latest(d("stamped_events"), ["user_id", "event_type"], "stamp", ["event_id"], total=True)
    return rows.select("user_id", "event_id", "event_type", "value")


@query(
    "dedupe_first",
    """SELECT l_partkey, l_orderkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
       ORDER BY l_shipdate, l_orderkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(d):
    rows = O.dedupe_first(d("lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_suppkey"], total=True)
    return rows.select("l_partkey", "l_orderkey", "l_suppkey", "l_quantity")


@query(
    "dedupe_last",
    """SELECT l_partkey, l_orderkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
       ORDER BY l_shipdate DESC, l_orderkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(d):
    rows = O.dedupe_last(d("lineitem"), ["l_partkey"], ["l_shipdate", "l_orderkey", "l_suppkey"], total=True)
    return rows.select("l_partkey", "l_orderkey", "l_suppkey", "l_quantity")


@query(
    "dedupe_hot_key",
    """SELECT lang, doc_id, n_chars, text FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) AS rn
       FROM documents) WHERE rn = 1""",
)
def _(d):
    return O.dedupe_latest(d("documents"), ["lang"], "n_chars", ["doc_id"], total=True).select("lang", "doc_id", "n_chars", "text")


@query(
    "load_summary",
    """SELECT count(*) AS rows_in, count(*) FILTER (WHERE status IS NOT NULL AND trim(status) <> '') AS rows_loaded,
         count(*) FILTER (WHERE status IS NULL OR trim(status) = '') AS rows_skipped FROM {partial_lines}""",
)
def _(d):
    return O.load_summary(O.require_all(d("partial_lines"), ["status"]))
