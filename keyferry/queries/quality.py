"""Casts, constraint checks, rejects and load counts over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as O
from ..specs import ForeignKey, Lookup, MergeSpec, TableSpec, columns
from .base import query, source

source(
    "raw_lines",
    """
    SELECT l_orderkey, l_partkey, l_suppkey,
      CASE WHEN l_returnflag = 'R' AND l_quantity > 40 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END AS qty,
      CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN l_orderkey + 1000000000 ELSE l_orderkey END AS order_ref,
      CASE WHEN l_linenumber = 7 THEN CAST(NULL AS STRING) ELSE l_linestatus END AS status,
      CASE WHEN l_linenumber = 6 THEN 'Z' ELSE l_returnflag END AS flag, l_extendedprice * 100 AS amount
    FROM {lineitem}
    """,
)
LINE = TableSpec(
    "line",
    columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, qty int, order_ref bigint, "
        "status string, flag string, amount decimal(9,2)"
    ),
    required=("status", "qty"),
    unique=(("order_ref", "flag"),),
    foreign=(ForeignKey("order_ref", "order", "o_orderkey"),),
    domains={"flag": ("A", "N", "R")},
)
KEY = ["l_orderkey", "l_partkey", "l_suppkey"]


@query(
    "cast_to_spec",
    """SELECT l_orderkey, l_partkey, l_suppkey, try_cast(qty AS INT) AS qty,
         CASE WHEN abs(amount) < 9999999.995 THEN round(amount, 2) END AS amount,
         CASE WHEN qty IS NOT NULL AND try_cast(qty AS INT) IS NULL THEN 'cast:qty' WHEN abs(amount) >= 9999999.995 THEN 'cast:amount' END AS reason
       FROM {raw_lines}""",
)
def _(d):
    rows = O.cast_to_spec(d("raw_lines"), LINE)
    return rows.select(*KEY, "qty", F.col("amount").cast("double").alias("amount"), F.col(O.REJECT).alias("reason"))


@query(
    "validate_rows",
    """SELECT l_orderkey, l_partkey, l_suppkey, nullif(concat_ws(',', CASE WHEN status IS NULL THEN 'required:status' END,
         CASE WHEN flag NOT IN ('A','N','R') THEN 'domain:flag' END), '') AS reason FROM {raw_lines}""",
)
def _(d):
    rows = O.validate(d("raw_lines"), LINE, unique=False)
    return rows.select(*KEY, F.col(O.REJECT).alias("reason"))


@query(
    "fk_violations",
    """SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN order_ref NOT IN (SELECT o_orderkey FROM orders) THEN 'fk:order_ref' END AS reason
       FROM {raw_lines}""",
)
def _(d):
    rows = O.fk_violations(d("raw_lines"), d("orders"), "order_ref", "o_orderkey")
    return rows.select(*KEY, F.col(O.REJECT).alias("reason"))


@query(
    "unique_violations",
    """SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN row_number() OVER (PARTITION BY order_ref, flag ORDER BY l_partkey, l_suppkey) > 1
         THEN 'unique:order_ref+flag' END AS reason FROM {raw_lines}""",
)
def _(d):
    rows = O.unique_violations(d("raw_lines"), [["order_ref", "flag"]], ["l_partkey", "l_suppkey"])
    return rows.select(*KEY, F.col(O.REJECT).alias("reason"))


CHECKED = """
    WITH a AS (SELECT *, CASE WHEN qty = 'n/a' THEN 'cast:qty' WHEN abs(amount) >= 9999999.995 THEN 'cast:amount' END AS r0,
        nullif(concat_ws(',', CASE WHEN status IS NULL THEN 'required:status' END, CASE WHEN qty = 'n/a' THEN 'required:qty' END,
          CASE WHEN flag NOT IN ('A','N','R') THEN 'domain:flag' END), '') AS r1,
        CASE WHEN order_ref NOT IN (SELECT o_orderkey FROM orders) THEN 'fk:order_ref' END AS r2 FROM {raw_lines}),
    b AS (SELECT *, coalesce(r0, r1, r2) AS r FROM a),
    c AS (SELECT *, CASE WHEN r IS NULL THEN row_number() OVER (PARTITION BY order_ref, flag, r ORDER BY l_partkey, l_suppkey) END AS rn FROM b),
    f AS (SELECT *, coalesce(r, CASE WHEN rn > 1 THEN 'unique:order_ref+flag' END) AS reason FROM c)"""


def _checked(d):
    cast = O.cast_to_spec(d("raw_lines"), LINE)
    return O.validate(cast, LINE, {"order": d("orders")}, order=["l_partkey", "l_suppkey"])


@query(
    "constraint_report",
    CHECKED + " SELECT coalesce(reason, 'ok') AS reason, count(*) AS n FROM f GROUP BY 1",
)
def _(d):
    rows = _checked(d)
    return rows.groupBy(F.coalesce(F.col(O.REJECT), F.lit("ok")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "reject_report",
    CHECKED
    + """ SELECT 'line' AS object_name, l_orderkey || '-' || l_partkey AS row_key, split_part(reason, ':', 1) AS error_type, reason AS error_message,
          '{"order_ref":' || order_ref || ',"flag":"' || flag || '"}' AS raw_row FROM f WHERE reason IS NOT NULL""",
)
def _(d):
    rows = _checked(d).withColumn("k", F.concat_ws("-", "l_orderkey", "l_partkey"))
    return O.reject_report(rows, "line", "k", ["order_ref", "flag"])


@query(
    "report_sample",
    """SELECT order_ref, l_partkey, l_suppkey FROM {raw_lines} WHERE order_ref NOT IN (SELECT o_orderkey FROM orders)
       ORDER BY order_ref, l_partkey, l_suppkey LIMIT 20""",
)
def _(d):
    rows = O.fk_violations(d("raw_lines"), d("orders"), "order_ref", "o_orderkey")
    missing = rows.filter(F.col(O.REJECT).isNotNull()).select("order_ref", "l_partkey", "l_suppkey")
    return O.report_sample(missing, ["order_ref", "l_partkey", "l_suppkey"])


source(
    "step_accounts",
    "SELECT c_custkey AS code, CASE WHEN c_acctbal < 0 THEN 99 ELSE c_nationkey END AS nation_ref, c_name AS name FROM {customer}",
)


@query(
    "load_chain_summary",
    """WITH a AS (SELECT code FROM {step_accounts} JOIN nation ON nation_ref = n_nationkey),
       o AS (SELECT o_orderkey, o_custkey IN (SELECT code FROM a) AS ok FROM orders),
       l AS (SELECT l_orderkey IN (SELECT o_orderkey FROM o WHERE ok) AS ok FROM lineitem)
       SELECT 'accounts' AS step, (SELECT count(*) FROM {step_accounts}) AS rows_in, (SELECT count(*) FROM a) AS rows_loaded,
         (SELECT count(*) FROM {step_accounts}) - (SELECT count(*) FROM a) AS rows_skipped
       UNION ALL SELECT 'orders', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM o
       UNION ALL SELECT 'lines', count(*), count(*) FILTER (WHERE ok), count(*) FILTER (WHERE NOT ok) FROM l""",
)
def _(d):
    """Three dependent loads: each resolves its parent among what the step before has loaded."""
    nations = O.key_map(d("nation"), "n_nationkey", "n_name", unique=True)
    accounts = O.lookup_required(d("step_accounts"), [Lookup("nation_ref", nations, "nation", True)])
    orders = O.lookup_required(
        d("orders"), [Lookup("o_custkey", _loaded(accounts, "code"), "account", True)]
    )
    lines = O.lookup_required(
        d("lineitem"), [Lookup("l_orderkey", _loaded(orders, "o_orderkey"), "order_id", True)]
    )
    out = None
    for name, rows in (("accounts", accounts), ("orders", orders), ("lines", lines)):
        one = O.load_summary(rows).select(F.lit(name).alias("step"), "rows_in", "rows_loaded", "rows_skipped")
        out = one if out is None else out.unionByName(one)
    return out


def _loaded(rows, key):
    """Key map of what a merge of the kept rows leaves in an empty target."""
    kept, _ = O.split_rejects(rows)
    ids = kept.select(key, F.col(key).alias("id"))
    merged = O.merge(ids.limit(0), ids, MergeSpec((key,)))
    return O.key_map(merged, key, "id", unique=True)


# Lines cut down to three columns: most values of the key are shared, and most rows have exact copies.
source(
    "copied_lines",
    "SELECT CASE WHEN l_linenumber < 7 THEN l_orderkey % 500 END AS ref, l_returnflag AS flag, CAST(l_quantity AS DOUBLE) AS qty FROM {lineitem}",
)


@query(
    "unique_violations_exact_copies",
    """SELECT ref, flag, qty, CASE WHEN ref IS NOT NULL AND row_number() OVER (PARTITION BY ref, flag ORDER BY qty) > 1 THEN 'unique:ref+flag' END AS reason
       FROM {copied_lines}""",
)
def _(d):
    rows = O.unique_violations(d("copied_lines"), [["ref", "flag"]], ["qty"])
    return rows.select("ref", "flag", "qty", F.col(O.REJECT).alias("reason"))
