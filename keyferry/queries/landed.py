"""Landed files and stored tables: files and tables are made from whole driver tables, then read and merged."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import operators as O
from ..plans import TABLES, Audit, LoadConfig, StoreRun, run_steps
from ..plans.extracts import SOURCES as OBJECTS
from ..session import scratch
from ..sources import TableStore, records, scan_csv
from ..sources.extracts import scan_marked
from ..specs import MergeSpec, SourceSpec, TableSpec, columns
from .base import ORACLES, query, source
from .loads import _shaped, out
from .merges import COLS, ORDER, _merge_sql, _sets

# --- merges that touch few buckets ------------------------------------------------------------
# The lines of the newest day, as a small delta into all orders.
source("newest", "SELECT * FROM {batch} WHERE updated_at = (SELECT max(updated_at) FROM {batch})")
STORED = TableSpec("stored", columns("code bigint, alt string, price double, note string, created_at timestamp_ntz, updated_at timestamp_ntz, created_by string"))


def _bucketed(d) -> TableStore:
    store = TableStore(d.spark, scratch(d.spark), buckets=64)
    store.commit(STORED, _shaped(d("stored"), STORED.schema), ("code",))
    return store


@query("merge_touched_buckets", _merge_sql("code", _sets()).replace("{batch}", "{newest}"))
def _(d):
    store = _bucketed(d)
    delta = store.stage("newest", d("newest"))
    return store.merge_into(STORED, delta, MergeSpec(("code",), ORDER)).select(COLS)


# --- records applied one after the other ------------------------------------------------------
# An order moves to another second key if a line was returned; then somebody may claim the key it left, and
# then the key it took. Applied by classes instead of in order the second record would change the order.
source("held", "SELECT 'o' || CAST(o_orderkey AS STRING) AS id, 'S' || CAST(o_orderkey AS STRING) AS sf_id, 'K' || CAST(o_orderkey AS STRING) AS case_id, 'stored' AS name FROM {orders}")
source(
    "moves",
    """
    SELECT 'm' || CAST(l_orderkey AS STRING) AS id, 'S' || CAST(l_orderkey AS STRING) AS sf_id, 'N' || CAST(l_orderkey AS STRING) AS case_id, 'moved' AS name, 1 AS seq
      FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY l_orderkey
    UNION ALL SELECT 'c' || CAST(l_orderkey AS STRING), 'T' || CAST(l_orderkey AS STRING), 'K' || CAST(l_orderkey AS STRING), 'claims', 2
      FROM {lineitem} WHERE l_returnflag = 'A' GROUP BY l_orderkey
    UNION ALL SELECT 'f' || CAST(l_orderkey AS STRING), 'T' || CAST(l_orderkey AS STRING), 'N' || CAST(l_orderkey AS STRING), 'follows', 3
      FROM {lineitem} WHERE l_returnflag = 'N' GROUP BY l_orderkey
    """,
)
IN_ORDER = """WITH k AS (SELECT o_orderkey::VARCHAR AS k, coalesce(bool_or(l_returnflag = 'R'), false) AS m, coalesce(bool_or(l_returnflag = 'A'), false) AS c,
    coalesce(bool_or(l_returnflag = 'N'), false) AS f FROM {orders} LEFT JOIN {lineitem} ON l_orderkey = o_orderkey GROUP BY o_orderkey)"""


def _in_order(d):
    return O.merge_in_order(d("held"), d("moves"), ("sf_id", "case_id"), MergeSpec(("sf_id",), ("seq",)))


@query(
    "guarded_in_order",
    IN_ORDER
    + """ SELECT 'o' || k AS id, 'S' || k AS sf_id, CASE WHEN m THEN 'N' ELSE 'K' END || k AS case_id,
         CASE WHEN m AND f AND NOT c THEN 'follows' WHEN m THEN 'moved' WHEN c THEN 'claims' ELSE 'stored' END AS name FROM k
       UNION ALL SELECT 'c' || k, 'T' || k, 'K' || k, 'claims' FROM k WHERE m AND c
       UNION ALL SELECT 'f' || k, 'T' || k, 'N' || k, 'follows' FROM k WHERE f AND NOT m""",
)
def _(d):
    return _in_order(d)[0]


@query(
    "guarded_in_order_actions",
    IN_ORDER
    + """ SELECT 'm' || k AS source_id, 'o' || k AS target_id, 'updated' AS action FROM k WHERE m
       UNION ALL SELECT 'c' || k, CASE WHEN m THEN 'c' ELSE 'o' END || k, CASE WHEN m THEN 'inserted' ELSE 'updated' END FROM k WHERE c
       UNION ALL SELECT 'f' || k, CASE WHEN m AND c THEN NULL WHEN m THEN 'o' || k ELSE 'f' || k END,
         CASE WHEN m AND c THEN 'duplicate_conflict' WHEN m THEN 'updated' ELSE 'inserted' END FROM k WHERE f""",
)
def _(d):
    return _in_order(d)[1].select("source_id", "target_id", "action")


# --- CSV files with quoted line breaks --------------------------------------------------------
# Of eleven parts one lacks a field, one has one too many, some hold quotes, commas and line breaks.
source(
    "part_lines",
    """SELECT CAST(p_partkey AS STRING) || ',' || CASE WHEN p_partkey % 3 = 0 THEN '"' || p_name || chr(10) || '""' || p_brand || '"", "' ELSE p_name END
         || CASE WHEN p_partkey % 11 = 4 THEN '' WHEN p_partkey % 11 = 7 THEN ',x,y' ELSE ',' || CASE WHEN p_size < 10 THEN '' ELSE p_type END END AS value,
       p_partkey % 11 IN (4, 7) AS odd, p_partkey, p_name, p_brand, p_type, p_size FROM {part}""",
)


def _part_file(d) -> str:
    path = scratch(d.spark)
    head = d.spark.range(1).select(F.lit("id,name,type").alias("value"))
    lines = d("part_lines").select("value")
    head.unionByName(lines).coalesce(1).write.text(path)  # one file: it is the reading that is split
    return path


def _small_splits(d, fn):
    """Read with splits far smaller than usual, so that records lie across their borders."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [d.spark.conf.get(n) for n in names]
    for n, v in zip(names, ("16k", "0")):
        d.spark.conf.set(n, v)
    try:
        return fn()
    finally:
        for n, v in zip(names, before):
            d.spark.conf.set(n, v)


@query(
    "csv_quoted_breaks",
    """SELECT p_partkey::VARCHAR AS id, CASE WHEN p_partkey % 3 = 0 THEN p_name || chr(10) || '"' || p_brand || '", ' ELSE p_name END AS name,
       CASE WHEN p_size >= 10 THEN p_type END AS type FROM {part_lines} WHERE NOT odd""",
)
def _(d):
    return _small_splits(d, lambda: scan_csv(d.spark, _part_file(d))[0])


@query("csv_shape_rejects", "SELECT value AS raw, 'malformed' AS reason FROM {part_lines} WHERE odd")
def _(d):
    return _small_splits(d, lambda: scan_csv(d.spark, _part_file(d))[1])


@query("csv_records", "SELECT count(*) + 1 AS n_records, sum(length(value))::BIGINT + 12 AS n_chars FROM {part_lines}")
def _(d):
    return _small_splits(d, lambda: records(d.spark, _part_file(d)).agg(F.count("*").alias("n_records"), F.sum(F.length("record")).alias("n_chars")))


# --- JSON lines, each with one verdict --------------------------------------------------------
source(
    "customer_lines",
    """SELECT '{{"Id": "' || CAST(c_custkey AS STRING) || '", "Name": "' || c_name || '"' || CASE WHEN c_custkey % 7 = 1 THEN '' ELSE ', "IsDeleted": ' ||
         CASE WHEN c_custkey % 5 = 1 THEN 'true' ELSE 'false' END END || ', "Count": ' || CASE WHEN c_custkey % 13 = 2 THEN '"many"' ELSE CAST(c_nationkey AS STRING) END
         || CASE WHEN c_custkey % 17 = 3 THEN '' ELSE '}}' END AS value, c_custkey, c_nationkey FROM {customer}""".replace("{{", "' || chr(123) || '").replace("}}", "' || chr(125) || '"),
)
LINES = SourceSpec("lines", ("Id", "Name", "IsDeleted", "Count"), {"IsDeleted": columns("x boolean")[0].dataType, "Count": columns("x bigint")[0].dataType})


@query(
    "json_one_verdict",
    """WITH v AS (SELECT *, CASE WHEN c_custkey % 13 = 2 OR c_custkey % 17 = 3 THEN 'malformed' WHEN c_custkey % 7 = 1 THEN 'missing:IsDeleted'
         WHEN c_custkey % 5 = 1 THEN 'deleted' ELSE 'kept' END AS verdict FROM {customer_lines})
       SELECT verdict, count(*) AS n FROM v WHERE verdict <> 'deleted' GROUP BY 1""",
)
def _(d):
    path = scratch(d.spark)
    d("customer_lines").select("value").write.text(path)
    kept, bad = scan_marked(d.spark, path, LINES)
    # one column of the kept rows: a verdict that hung on the columns read would count some lines twice
    return kept.select(F.lit("kept").alias("verdict"), "Id").groupBy("verdict").agg(F.count("Id").alias("n")).unionByName(
        bad.groupBy(F.col("reason").alias("verdict")).agg(F.count(F.lit(1)).alias("n"))
    )


# --- numbers without limits -------------------------------------------------------------------
source("long_numbers", "SELECT p_partkey, CAST(p_size AS STRING) || '.' || lpad(CAST(p_partkey * 10 AS STRING), 12, '0') AS num FROM {part}")


@query(
    "cast_exact_numbers",
    """SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN num::DECIMAL(38,10)::DOUBLE END AS num,
         CASE WHEN p_partkey % 10 <> 0 THEN 'cast:num' END AS reject
       FROM {long_numbers} UNION ALL SELECT -p_partkey, NULL, 'cast:num' FROM {long_numbers}""",
)
def _(d):
    spec = TableSpec("numbers", columns("p_partkey bigint, num decimal(38,10)"))
    rows = d("long_numbers").unionByName(d("long_numbers").select((-F.col("p_partkey")).alias("p_partkey"), F.concat("num", F.lit("00001")).alias("num")))
    cast = O.cast_to_spec(rows, spec)
    return cast.select("p_partkey", F.when(F.col(O.REJECT).isNull(), F.col("num").cast("double")).alias("num"), F.col(O.REJECT).alias("reject"))


# --- audited runs over landed files and a store -----------------------------------------------
def _ran(d) -> tuple[TableStore, Audit]:
    """Programs and locations, landed as JSON lines, loaded twice into stored tables in buckets."""
    root = scratch(d.spark)
    store = TableStore(d.spark, f"{root}/store", buckets=8)
    for name in ("programs", "locations"):
        _shaped(d(f"x_{name}"), OBJECTS[name].schema()).write.json(f"{root}/landed/{OBJECTS[name].name}")
        store.commit(TABLES[name], _shaped(d(f"t_{name}"), TABLES[name].schema), ("sf_id",))
    run = StoreRun(d.spark, LoadConfig("sys", delta=True, now="2030-01-01 00:00:00"), {}, store=store, landing=f"{root}/landed")
    audit = Audit(store)
    for _ in range(2):
        run_steps(audit, run, ["programs", "locations"], "op@x.test")
    return store, audit


@query("run_programs_twice", None)
def _(d):
    store, _ = _ran(d)
    return out(store.read(TABLES["programs"]), "id", "sf_id", "program_name", "program_code", "created_at", "updated_at", "created_by_id", "last_updated_by_id")


ORACLES["run_programs_twice"] = ORACLES["load_programs"]


@query(
    "run_audit",
    """SELECT 'programs' AS object_name, 'SUCCESS' AS status, count(*) AS rows_in, count(DISTINCT Name) AS rows_out, 2::BIGINT AS n FROM {x_programs}
       UNION ALL SELECT 'locations', 'SUCCESS', count(*), count(*), 2 FROM {x_locations}""",
)
def _(d):
    _, audit = _ran(d)
    return audit.tasks().groupBy("object_name", "status", "rows_in", "rows_out").agg(F.count(F.lit(1)).alias("n"))
